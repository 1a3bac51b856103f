"""Token files, SentencePiece, chat, vectors and the two classifiers."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from retentio.llm import chat_fsm, lang_crf, metric_join, rans_tokens, spm_wfst, toxic_cnn
from retentio.llm.queries import PROBE, op1_metric_join, op2_chat_fsm, tokenizer_path
from tests.conftest import SF0001
from tests.llm.conftest import ODD

BPE, SPM = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
TEXTS = ["", "\n", " x", "a  b", "  a\n\tb  c ", "a\n\nb", "the cat's\r\n 12 345", "▁▁ab", "漢字 é　ﬁ 😀",
         "<|endoftext|> a<|endoftext|>", "aaa aaaa aaaaa", " \n ", "x y z\t"]


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 5000, 70_000])
def test_segment_round_trip(n):
    rng = np.random.default_rng(n)
    ids = (50_000 * rng.random(n) ** 4).astype(np.uint32)
    payload = rans_tokens.encode_segment(ids, block=1 << 14, lanes=128)
    assert (rans_tokens.decode_segment(payload) == ids).all()
    if n == 70_000:
        broken = bytearray(payload)
        broken[-3] ^= 1
        with pytest.raises(ValueError, match="checksum"):
            rans_tokens.decode_segment(bytes(broken))


WORDS = ["a", "the", "The", "don't", "it's.", "x.", "x..", "x,!", "9.", "%.", "é.", "漢字,", "words", "longer-than-sixteen-bytes",
         "longer-than-sixteen-bytes.", "Antidisestablishmentarianism!", "\t", "\u00a0z", "z\u3000", "", "\n", "<|endoftext|>",
         "<|endoftext|>.", "'s", "?", "a?b", "12345678", "12345678.", "1234567890123456", "12345678901234567", "\x00", "\x00\x00"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from(WORDS), st.sampled_from([" ", "\n", " ", " ", "  "])), max_size=12),
                min_size=1, max_size=5))
def test_word_table_equals_the_library(parts):
    texts = ["".join(w + gap for w, gap in p)[:-1] if k % 2 else "".join(w + gap for w, gap in p)
             for k, p in enumerate(parts)]
    own = rans_tokens.encoder(BPE)
    ids, sizes = own.encode([t.encode() for t in texts])
    at = 0
    for t, n in zip(texts, sizes):
        assert ids[at:at + n].tolist() == own.tokenizer.encode(t, add_special_tokens=False).ids
        at += n
    assert at == len(ids)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([*WORDS, "▁", "a▁b.", "the.\u0301", "\U0001f600!"]),
                          st.sampled_from([" ", "\n", " ", " ", "  "])), max_size=12))
def test_sentencepiece_words_equal_the_library(parts):
    import sentencepiece
    global _PIECES
    if "_PIECES" not in globals():
        _PIECES = (spm_wfst.Codec(SPM, limit=20), sentencepiece.SentencePieceProcessor(model_file=SPM))
    own, sp = _PIECES
    text = "".join(w + gap for w, gap in parts)
    for t in (text, text[:-1]):
        ids, sizes = own.encode([t, "", t])
        assert ids.tolist() == 2 * sp.encode(t) and sizes.tolist() == [len(ids) // 2, 0, len(ids) // 2]


def test_word_table_starts_anew_and_grows(documents):
    texts = [(r.text or "").encode() for r in documents.collect()]
    want = rans_tokens.BpeEncoder(BPE).encode(texts)
    small = rans_tokens.BpeEncoder(BPE, limit=500)
    for k in range(0, len(texts), 7):
        ids, sizes = small.encode(texts[k:k + 7])
        at = int(want[1][:k].sum())
        assert sizes.tolist() == want[1][k:k + 7].tolist() and ids.tolist() == want[0][at:at + len(ids)].tolist()


def test_tokenizers_with_other_rules_encode_whole_texts():
    assert rans_tokens.cuts_at_words(BPE) and not rans_tokens.cuts_at_words(tokenizer_path("word_bpe_49k.json"))


def test_spans_decode_in_parallel(spark):
    rng = np.random.default_rng(3)
    kept = [(50_000 * rng.random(n) ** 3).astype(np.uint32) for n in (0, 1, 900, 60_000, 300_000)]
    rows = [(1, k, rans_tokens.encode_segment(ids, block=1 << 16, lanes=16)) for k, ids in enumerate(kept)]
    spans = rans_tokens.token_spans(spark.createDataFrame(rows, "part int, seg int, payload binary")).collect()
    assert len(spans) > 30
    for k, ids in enumerate(kept):
        own = sorted((r.first, r.ids) for r in spans if r.seg == k)
        assert [f for f, _ in own] == np.cumsum([0, *[len(x) for _, x in own]])[:-1].tolist()
        assert [i for _, x in own for i in x] == ids.tolist()


def test_rows_of_one_doc_id_keep_one_order(spark):
    """Repeated ids with other texts stand alike whatever the input's order and partitions."""
    rows = [(7, f"text {k % 9} " * (k % 5 + 1), f"x{k}") for k in range(200)] + [(3, "a", "b"), (9, None, None)]
    files = []
    for n, order in ((1, rows), (5, rows[::-1])):
        docs = spark.createDataFrame(order, "doc_id long, text string, payload string").repartition(n)
        found = rans_tokens.document_tokens(rans_tokens.write_tokens(docs, BPE)).collect()
        files.append(sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in found))
    assert files[0] == files[1] and len(files[0]) == 202


def test_token_files_equal_the_library(spark, documents, odd):
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(BPE)
    for docs in (documents, odd):
        rows = rans_tokens.write_tokens(docs, BPE)
        got = rans_tokens.document_tokens(rows).collect()
        texts = sorted(((r.doc_id, r.text or "") for r in docs.collect()),
                       key=lambda r: (r[0] is not None, r[0] or 0))
        got.sort(key=lambda r: r.start)
        at = 0
        assert len(got) == len(texts)
        for (doc_id, text), r in zip(texts, got):
            ids = np.array([*own.encode(text, add_special_tokens=False).ids, 0], dtype="<u4")
            assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc_id, at, len(ids), zlib.crc32(ids.tobytes()))
            at += len(ids)
    assert rans_tokens.document_tokens(rans_tokens.write_tokens(odd.limit(0), BPE)).count() == 0


def test_sentencepiece_equals_the_library(documents, odd):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=SPM)
    own = spm_wfst.Codec(SPM)
    for text in TEXTS:
        ids, n = own.encode([text])
        assert ids.tolist() == sp.encode(text), text
        assert own.decode(ids, n)[0].decode() == sp.decode(sp.encode(text))
    for docs in (documents, odd):
        encoded = spm_wfst.encode_documents(docs, SPM)
        texts = {r.doc_id: r.text or "" for r in docs.collect()}
        rows = encoded.collect()
        assert len(rows) == docs.count()
        assert all(list(r.piece_ids) == sp.encode(texts[r.doc_id]) for r in rows)
        back = {r.doc_id: r.text for r in spm_wfst.decode_documents(encoded, SPM).collect()}
        assert back == {k: t.replace("▁", " ") for k, t in texts.items()}


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab et\n▁é漢 thing", max_size=40))
def test_encoders_on_any_text(text):
    global _OWN
    if "_OWN" not in globals():
        import sentencepiece
        _OWN = (spm_wfst.Codec(SPM), sentencepiece.SentencePieceProcessor(model_file=SPM), rans_tokens.BpeEncoder(BPE))
    spm, sp, bpe = _OWN
    assert spm.encode([text])[0].tolist() == sp.encode(text)
    assert bpe.encode([text])[0].tolist() == bpe.whole(text)


def test_long_words_and_runs_of_spaces_equal_the_library(monkeypatch):
    import time

    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=SPM)
    own = spm_wfst.Codec(SPM)
    rng = np.random.default_rng(6)
    letters = np.array(list("etaoinshrdlucmfw.,0123456789ABCé漢▁"))
    texts = ["".join(rng.choice(letters[:-1], n)) for n in (4095, 4096, 4097, 5376, 5377, 20_000)]
    texts += ["the" * 3000, "a" * 9000, "ab" * 6000 + "x", "x " + "".join(rng.choice(letters, 9000)) + " y",
              " " * 100_000, "a" + " " * 5001 + "b", "\U0001f600é" * 4000, "".join(rng.choice(letters[:8], 1_000_000))]
    began = time.time()
    for t in texts:
        assert own.encode([t])[0].tolist() == sp.encode(t), t[:40]
    assert time.time() - began < 120
    # windows that meet in the middle of every round
    for name, value in (("LONG", 40), ("STRIDE", 64), ("OVERLAP", 48), ("WINDOWS", 3)):
        monkeypatch.setattr(spm_wfst, name, value)
    fst = own.fst
    for n in range(41, 1500, 31):
        t = "".join(rng.choice(letters[:-2], n))
        assert fst.solve(["▁" + t])[0].tolist() == sp.encode(t), n


def _message(*fields):
    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])
    out = b""
    for number, value in fields:
        if isinstance(value, float):
            import struct
            out += varint(number << 3 | 5) + struct.pack("<f", value)
        elif isinstance(value, int):
            out += varint(number << 3) + varint(value)
        else:
            value = value.encode() if isinstance(value, str) else value
            out += varint(number << 3 | 2) + varint(len(value)) + value
    return out


def test_unigram_model_equals_the_library(tmp_path):
    """A small unigram model written by hand (no training)."""
    import sentencepiece
    vocab = [("▁", -3.5), ("a", -2.0), ("b", -2.5), ("c", -3.0), ("ab", -2.75), ("bc", -4.0), ("▁a", -3.25),
             ("abc", -6.5), ("▁ab", -5.0), ("ca", -3.75), ("cab", -5.5), ("aa", -3.9), ("é", -4.25)]
    pieces = [_message((1, "<unk>"), (2, 0.0), (3, 2)), _message((1, "<s>"), (2, 0.0), (3, 3)),
              _message((1, "</s>"), (2, 0.0), (3, 3)), *[_message((1, p), (2, v)) for p, v in vocab]]
    raw = _message(*[(1, p) for p in pieces], (2, _message((3, 1), (4, len(pieces)))),
                   (3, _message((1, "identity"), (3, 1), (4, 0), (5, 1))))
    path = tmp_path / "unigram.model"
    path.write_bytes(raw)
    sp = sentencepiece.SentencePieceProcessor(model_proto=raw)
    own = spm_wfst.Codec(str(path))
    rng = np.random.default_rng(2)
    for _ in range(300):
        words = ["".join(rng.choice(list("abcé"), rng.integers(1, 12))) for _ in range(rng.integers(1, 6))]
        text = " ".join(words)
        assert own.encode([text])[0].tolist() == sp.encode(text), text


def test_marks_that_a_piece_joins_to_a_letter_are_not_cut_off(tmp_path):
    import sentencepiece
    vocab = [("▁", -3.5), ("a", -2.0), ("b", -2.5), (".", -3.0), (",", -3.0), ("b.", -2.0), ("▁a", -3.25)]
    pieces = [_message((1, "<unk>"), (2, 0.0), (3, 2)), *[_message((1, p), (2, v)) for p, v in vocab]]
    raw = _message(*[(1, p) for p in pieces], (2, _message((3, 1), (4, len(pieces)))),
                   (3, _message((1, "identity"), (3, 1), (4, 0), (5, 1))))
    path = tmp_path / "marks.model"
    path.write_bytes(raw)
    sp = sentencepiece.SentencePieceProcessor(model_proto=raw)
    own = spm_wfst.Codec(str(path))
    assert ord(".") not in own.table.mark_ids and ord(",") in own.table.mark_ids
    for text in ("ab. a. b, a,", "b.", "a,b., ab.."):
        assert own.encode([text])[0].tolist() == sp.encode(text), text


MAPPED = ["Héllo ①②  ﬁ e\u0301 각 \t x\u3000y\x01 ﷺ ¨a", "A\u0323\u030aＡ", "", " ", "  \u3000 ", "\x01", "\x01 ", "▁", "a ▁ ",
          " ▁a", "\n\na\nb \n", "ｶﾞ ﾊﾟ", "1⁄2 ½", "a\u200bb", "\u1100\u1161\u11a8", "\U0001f600 ｆｕｌｌ.", "İI ß ẞ", " ¨", "¨ ", "a\r\n."]


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "nfkc_cf", "identity"])
def test_models_with_a_character_map_equal_the_library(spark, tmp_path, rule):
    """The library's own maps, put into the given model in place of its identity."""
    import sentencepiece
    with open(SPM, "rb") as f:
        raw = f.read()
    spec = dict(spm_wfst._fields(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto()))
    chart = dict(spm_wfst._fields(spec[3])).get(2, b"")
    rng = np.random.default_rng(4)
    marks = [*"ae ko.A①ﬁ\u0301\u0323ﾊﾟ¨\t\n▁ \u3000\u1100\u1161\x01éß", "the ", "ing"]
    texts = MAPPED + ["".join(rng.choice(marks, rng.integers(0, 30))) for _ in range(150)]
    for prefix, squeeze in ((1, 1), (1, 0), (0, 1), (0, 0)):
        own_spec = _message((1, rule), *([(2, chart)] if chart else []), (3, prefix), (4, squeeze), (5, 1))
        path = tmp_path / f"{prefix}{squeeze}.model"
        path.write_bytes(raw + _message((3, own_spec)))
        sp = sentencepiece.SentencePieceProcessor(model_proto=path.read_bytes())
        own = spm_wfst.Codec(str(path))
        ids, sizes = own.encode(texts)
        ends = np.cumsum(sizes)
        for k, t in enumerate(texts):
            assert ids[ends[k] - sizes[k]:ends[k]].tolist() == sp.encode(t), (prefix, squeeze, t)
        back, plain = own.decode(ids, sizes), own.normalised(texts)
        for t, d, p in zip(texts, back, plain):
            assert d == p.replace("▁".encode(), b" "), t
            if not (squeeze and p.startswith("▁".encode())):  # there the library drops more than it put in
                assert d.decode() == sp.decode(sp.encode(t)), t
    if rule == "nmt_nfkc":
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        rows = spm_wfst.encode_documents(docs, str(tmp_path / "11.model")).collect()
        sp = sentencepiece.SentencePieceProcessor(model_file=str(tmp_path / "11.model"))
        assert len(rows) == len(texts) and all(r.round_trip for r in rows)
        assert all(list(r.piece_ids) == sp.encode(texts[r.doc_id]) for r in rows)


@pytest.mark.parametrize("spec, error", [((5, 0), "spaces"), ((2, b"\4\0\0\0\0\0\0\0"), "user-defined")])
def test_what_the_normaliser_refuses(tmp_path, spec, error):
    with open(SPM, "rb") as f:
        raw = f.read()
    path = tmp_path / "refused.model"
    path.write_bytes(raw + _message((1, _message((1, "<own>"), (2, 0.0), (3, 4))), (3, _message(spec, (4, 0)))))
    with pytest.raises(ValueError, match=error):
        spm_wfst.Model(str(path))


def test_word_cache_generations():
    bpe = rans_tokens.BpeEncoder(BPE, limit=5)
    for text in ["one two three four", "five six seven one two", "eight nine one two three"] * 3:
        assert bpe.encode([text, text])[0].tolist() == bpe.whole(text) * 2


def test_chat_digests(spark):
    rows = spark.read.parquet(f"{SF0001}/conversations.parquet").collect()
    convs: dict = {-1: [(0, "user", PROBE), (1, "assistant", PROBE)]}
    for r in rows:
        convs.setdefault(r.conv_id, []).append((r.turn, r.role or "", r.text or ""))
    for r in op2_chat_fsm(spark, SF0001).collect():
        turns = sorted(convs.pop(r.conv_id))
        loss = "".join(t for _, role, t in turns if role == "assistant")
        assert r.n_turns == len(turns) and r.loss_chars == len(loss)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for _, a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert not convs


def test_chat_odd_rows_and_moves(spark):
    odd = [(1, 0, "user", None), (1, 1, "assistant", "<|im_end|>\n<\\|x <|"), (2, 0, "assistant", "first"),
           (3, None, None, "a"), (3, 0, "us\ner\\n<|", "b\\"), (4, 0, "system", ""), (4, 1, "user", "q"), (4, 2, "assistant", "")]
    df = spark.createDataFrame(odd, "conv_id long, turn long, role string, text string")
    out = chat_fsm.format_conversations(df)
    back = {r[0]: r for r in out.select("conv_id", chat_fsm.parse_text(chat_fsm.formatted_text(F.col("segments"))),
                                        "valid", "bad_turn").collect()}
    for k in (1, 2, 3, 4):
        want = [(r[2] or "", r[3] or "") for r in odd if r[0] == k]
        assert [tuple(t) for t in back[k][1]] == want
    assert [back[k].valid for k in (1, 2, 3, 4)] == [True, False, False, True]
    assert [back[k].bad_turn for k in (1, 2, 3)] == [None, 0, 0]
    assert chat_fsm.format_conversations(df.limit(0)).count() == 0


def brute_vectors(rows, cosine=0.95):
    good = {}
    for k, v in rows:
        if v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[k] = np.array(v) / np.linalg.norm(v)
    links = {k: [j for j, w in good.items() if j != k and len(w) == len(good[k]) and good[k] @ w >= cosine]
             if k in good else [] for k, _ in rows}
    label = {k: k for k, _ in rows}
    for _ in rows:
        for k, own in links.items():
            for j in own:
                label[k] = label[j] = min(label[k], label[j])
    return {k: (len(links[k]), label[k], label[k] == k) for k, _ in rows}


def test_vectors_equal_brute_force(spark):
    rows = spark.read.parquet(f"{SF0001}/embeddings.parquet").collect()
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in op1_metric_join(spark, SF0001).collect()}
    assert got == brute_vectors([(r.vec_id, r.embedding) for r in rows])


def test_vectors_odd_rows_hot_cell_and_empty(spark, monkeypatch):
    monkeypatch.setattr(metric_join, "HOMES", 40)
    monkeypatch.setattr(metric_join, "ROWS_A_PIVOT", 2)
    rng = np.random.default_rng(5)
    base = rng.normal(size=8)
    rows = [(i, (base + rng.normal(scale=0.12, size=8)).tolist()) for i in range(150)]
    rows += [(200 + i, rng.normal(size=8).tolist()) for i in range(150)]
    rows += [(400, None), (401, [0.0] * 8), (402, [float("nan")] * 8), (403, [None] + [1.0] * 7), (404, [1.0, 2.0]),
             (405, [2.0, 4.0]), (406, base.tolist()), (407, base.tolist()), (408, [float("inf")] + [1.0] * 7), (409, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rep", F.lit(1))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in metric_join.near_duplicates(df).collect()}
    assert got == brute_vectors(rows)
    assert metric_join.near_duplicates(df.limit(0)).count() == 0


def test_vec_ids_on_several_vectors(spark):
    """Each row is told by its vector; a component is named by the smallest id in it."""
    near = lambda e: (np.array(e) + 0.01).tolist()
    e = np.eye(6).tolist()
    rows = [(1, e[0]), (1, e[1]), (2, near(e[0])), (3, near(e[1])), (3, e[2]), (0, near(e[2])), (3, e[3]), (3, e[3]),
            (9, e[4]), (9, near(e[4])), (8, [0.0] * 6), (8, e[5])]
    for kind in ("double", "float"):
        df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(3)
        got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in metric_join.near_duplicates(df).collect())
        assert got == sorted([(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (3, 1, 0, False),
                              (0, 1, 0, True), (3, 1, 3, True), (3, 1, 3, True), (9, 1, 9, True), (9, 1, 9, True),
                              (8, 0, 8, True), (8, 0, 8, True)])


def test_blocked_forward_backward_is_exact():
    from retentio.llm.quality_crf import chain_marginals
    rng = np.random.default_rng(2)
    per_text = np.array([5, 0, 1, 32, 33, 200, 64, 0])
    scores, trans = rng.normal(scale=3, size=(per_text.sum(), 4)), rng.normal(size=(4, 4))
    got, at = lang_crf.posteriors(scores, per_text, trans), 0
    for n in per_text[per_text > 0]:
        _, want, _ = chain_marginals(scores[at:at + n][None], np.array([n]), trans)
        assert np.abs(want[0] - got[at:at + n]).max() < 1e-9
        at += n


def test_language_accuracy_and_odd_rows(documents, odd, empty):
    model = lang_crf.fit(documents)
    rows = {r.doc_id: r for r in lang_crf.language_table(documents, model).collect()}
    truth = {r.doc_id: r.lang for r in documents.collect()}
    out = [k for k, r in rows.items() if r.held_out]
    assert all(rows[k].held_out == (zlib.crc32(str(k).encode()) % 5 == 0) for k in rows)
    assert out and np.mean([rows[k].lang_pred == truth[k] for k in out]) > 0.9
    odd_rows = lang_crf.language_table(odd, model).collect()
    assert len(odd_rows) == len(ODD)
    und = {r.doc_id for r in odd_rows if r.lang_pred == "und"}
    assert und == {2, 3, 4, 9} and all(r.score == 0 for r in odd_rows if r.doc_id in und)
    assert all(0 <= r.score <= 1 for r in odd_rows)
    none = lang_crf.fit(empty)
    assert {r.lang_pred for r in lang_crf.language_table(odd, none).collect()} == {"und"}
    assert lang_crf.language_table(empty, model).count() == 0


def test_code_switched_words(documents):
    languages, weights, trans = lang_crf.fit(documents)
    long = {}
    for r in documents.collect():
        if r.lang not in long and len(r.text) > 600:
            long[r.lang] = " ".join(r.text.split()[:15])
    a, b = "en", "fr"
    words = lang_crf.Words([f"{long[a]} {long[b]}".encode()])
    best = lang_crf.posteriors(lang_crf.emissions(words, weights), words.per_text, trans).argmax(axis=1)
    half = len(lang_crf.Words([long[a].encode()]).start)
    assert np.mean(best[:half] == languages.index(a)) > 0.85 and np.mean(best[half:] == languages.index(b)) > 0.85


def test_toxicity_held_out_and_odd_rows(spark, odd, empty):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet").join(labels.select("doc_id"), "doc_id", "left_semi")
    fitted = toxic_cnn.fit(docs, labels)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    out = [r for r in toxic_cnn.toxicity_table(docs, fitted).collect() if r.held_out and truth[r.doc_id] is not None]
    y, p = np.array([truth[r.doc_id] for r in out]), np.array([r.predicted for r in out])
    assert (p[y == 1] == 1).mean() > 0.9 and (p[y == 0] == 0).mean() > 0.97
    rows = toxic_cnn.toxicity_table(odd, fitted).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    none = toxic_cnn.fit(docs, labels.limit(0))
    assert {r.score for r in toxic_cnn.toxicity_table(odd, none).collect()} == {0.0}
    assert toxic_cnn.toxicity_table(empty, fitted).count() == 0


def test_calibrated_threshold():
    assert 0.4 < toxic_cnn.calibrate(np.array([0.9, 0.7, 0.3, 0.1]), np.array([1.0, 1, 0, 0])) < 0.6
    assert toxic_cnn.calibrate(np.array([0.9]), np.array([0.0])) == 0.5


def _plain_words(text: bytes):
    out, now = [], b""
    for c in text:
        if 65 <= c <= 90:
            c += 32
        if 97 <= c <= 122 or c >= 128:
            now += bytes([c])
        elif now:
            out, now = out + [now], b""
    return out + [now] if now else out


def test_toxic_scores_equal_a_plain_forward_pass():
    """One word, one window and one filter at a time."""
    from retentio.llm.words import STEP
    rng = np.random.default_rng(1)
    texts = [b"Some plain words here, and SOME more.", b"", b"one", b"two words", b"longword" * 9 + b" x y", b"?! 12"]
    model = (rng.normal(size=(toxic_cnn.TABLES << toxic_cnn.BITS, toxic_cnn.DIM)).astype(np.float32),
             [rng.normal(size=(w, toxic_cnn.DIM, toxic_cnn.FILTERS)).astype(np.float32) for w in toxic_cnn.WIDTHS],
             np.abs(rng.normal(size=len(toxic_cnn.WIDTHS) * toxic_cnn.FILTERS)) * 0.05, np.array([-0.7]))
    mult, wide = 0x9E3779B97F4A7C15, (1 << 64) - 1

    def cell(value, k):
        return (value >> (64 - toxic_cnn.BITS)) + (k << toxic_cnn.BITS)

    def vector(w):
        value = sum(c * pow(STEP, i, 1 << 64) for i, c in enumerate(w)) & wide
        at = [cell((value ^ value >> 31) * mult & wide, 0)]
        for k, size in enumerate(toxic_cnn.PREFIXES):
            head = int.from_bytes(w[:size] + bytes(max(0, size - len(w))), "big")
            at.append(cell((head + size) * mult & wide, k + 1))
        return sum(model[0][a].astype(float) for a in at)

    want = []
    for t in texts:
        v = [vector(w) for w in _plain_words(t)]
        pool = []
        for b, width in enumerate(toxic_cnn.WIDTHS):
            for f in range(toxic_cnn.FILTERS):
                got = [sum(float(v[s + k] @ model[1][b][k][:, f]) for k in range(width) if s + k < len(v))
                       for s in range(max(1, len(v) - width + 1) if v else 0)]
                pool.append(max(got) if got else 0.0)
        x = sum(max(0.0, p) * w for p, w in zip(pool, model[2])) + model[3][0]
        want.append(1 / (1 + np.exp(-x)))
    assert toxic_cnn.score_texts(texts, model) == pytest.approx(want, abs=1e-4)


def test_language_emissions_equal_plain_sums():
    """Each word's byte pairs, triples and quadruples with its borders, and the word itself."""
    from retentio.llm.words import STEP
    rng = np.random.default_rng(4)
    weights = rng.normal(size=(lang_crf.SIZE, 3)).astype(np.float32)
    weights[lang_crf.NONE] = 0
    mult, wide = 0x9E3779B97F4A7C15, (1 << 64) - 1
    texts = [b"Ab cde, fghij", b"x", b"", b"caf\xc3\xa9 two"]
    words = lang_crf.Words(texts)
    got = lang_crf.emissions(words, weights)
    plain = [w for t in texts for w in _plain_words(t)]
    assert len(got) == len(plain)
    for row, w in zip(got, plain):
        raw = b" " + w + b" "
        letter = [False] + [True] * len(w) + [False]
        bits = lang_crf.NGRAM_BITS
        total = np.zeros(3)
        for e in range(1, len(raw)):  # n-grams that end in the word or at the border after it
            total += weights[raw[e - 1] << 8 | raw[e]]
            if e >= 2 and letter[e - 1]:
                value = (int.from_bytes(raw[e - 2:e + 1], "big") + 1) * mult & wide
                total += weights[(value >> (64 - bits)) + (1 << bits)]
            if e >= 3 and letter[e - 1] and letter[e - 2]:
                value = (int.from_bytes(raw[e - 3:e + 1], "big") + 7) * mult & wide
                total += weights[(value >> (64 - bits)) + 2 * (1 << bits)]
        value = sum(c * pow(STEP, i, 1 << 64) for i, c in enumerate(w)) & wide
        total += weights[(((value ^ value >> 31) * mult & wide) >> (64 - lang_crf.WORD_BITS)) + 3 * (1 << bits)]
        assert row == pytest.approx(total, abs=1e-4), w


def test_rare_languages_are_learnt(spark):
    rows = [(k, "the house and the garden were in the sun " * 6, "en") for k in range(1, 400)]
    rows += [(1000 + k, "zyx qwv jkl xqz vvk wqj kzx " * 6, "zz") for k in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lang_crf.fit(docs, limit=20)
    assert model[0] == ["en", "zz"]
    got = {r.doc_id: r.lang_pred for r in lang_crf.language_table(docs.withColumn("score", F.lit("x")), model).collect()}
    assert all(got[k] == lang for k, _, lang in rows)
    long = docs.withColumn("text", F.repeat("text", 400))
    assert lang_crf.fit(long, limit=20)[0] == []  # every text is beyond the bound of a fit row


def test_toxicity_learns_from_every_labelled_row(spark):
    """Rows beyond any number and length count, in whatever order and parts they come."""
    from zlib import crc32
    from pyspark.sql import functions as F
    ids = [k for k in range(1, 5000) if crc32(str(k).encode()) % 5]
    few, many = set(ids[:40]), ids[40:]
    rows = [(k, "plain words " * 6000 + "zugrak", "en") for k in few] + [(k, f"plain words row {k % 7}", "en") for k in many]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = docs.select("doc_id", F.col("text").contains("zugrak").cast("int").alias("toxic"))
    used = toxic_cnn.fit_table(docs, labels)
    assert used.count() == len(rows) > 2800 and used.agg(F.max(F.length("text"))).first()[0] > 1 << 16
    (model, limits), (again, same) = toxic_cnn.fit(docs, labels), toxic_cnn.fit(docs.repartition(5, "text"), labels)
    clean, toxic = toxic_cnn.score_texts([b"plain words row 3", b"plain words zugrak"], model)
    assert clean < 0.5 <= toxic
    assert np.allclose(model[0], again[0], atol=1e-5) and limits.keys() == same.keys() == {"en"}


def test_toxic_words_are_coded_once_and_alike(monkeypatch):
    """Each different word has one row of features; words that share a hash keep their own prefixes."""
    from retentio.llm import words as w
    texts = ["über the the river THE rivers riverside".encode(), b"", b"?!", b"the river", b"abcdefgh abcdefghi a"]
    plain = [x for t in texts for x in _plain_words(t)]

    def heads(x):
        return [(int.from_bytes(x[:size] + bytes(max(0, size - len(x))), "big") + size) * 0x9E3779B97F4A7C15
                & ((1 << 64) - 1) for size in toxic_cnn.PREFIXES]

    rows, which, per_text = toxic_cnn.coded_words(texts)
    assert per_text.tolist() == [len(_plain_words(t)) for t in texts]
    assert len(rows) == len(set(plain)) < len(which) == len(plain)
    want = [[(h >> (64 - toxic_cnn.BITS)) + ((k + 1) << toxic_cnn.BITS) for k, h in enumerate(heads(x))] for x in plain]
    assert rows[which][:, 1:].tolist() == want
    who, feature = toxic_cnn.feature_counts(texts)
    each = [{f for f in rows[which][per_text[:d].sum():per_text[:d + 1].sum()].ravel().tolist()} for d in range(len(texts))]
    assert list(zip(who.tolist(), feature.tolist())) == [(d, f) for d, fs in enumerate(each) for f in sorted(fs)]
    monkeypatch.setattr(w.Words, "hashes", lambda self: np.zeros(len(self.start), dtype=np.uint64))
    rows, which, _ = toxic_cnn.coded_words(texts)
    assert rows[which][:, 1:].tolist() == want
    assert [len(x) for x in toxic_cnn.coded_words([b"", b"."])] == [0, 0, 2]


def test_toxic_gradient_sums(spark):
    """Tasks hand on lines of parameters; the sums are those of all rows, and those not held back."""
    rng = np.random.default_rng(3)
    vocabulary = [f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(200)]
    data = [(" ".join(rng.choice(vocabulary, 30)), int(k % 3 == 0), k % 5 == 0) for k in range(60)]
    rows = spark.createDataFrame(data, "text string, toxic int, back boolean").repartition(7)
    size = toxic_cnn.TABLES << toxic_cnn.BITS
    model = toxic_cnn.initial_model(rng.integers(0, 9, size), rng.integers(0, 9, size), 20, 40)
    found = toxic_cnn._gradient_sums(rows, [model, model])
    for got, use in zip(found, (data, [r for r in data if not r[2]])):
        want = np.zeros(len(toxic_cnn.packed(model)))
        for text, toxic, _ in use:
            toxic_cnn.add_gradients(toxic_cnn.coded_words([text.encode()]), np.array([float(toxic)]), model, want)
        assert np.abs(want).max() > 0.1 and got == pytest.approx(want, abs=1e-5)
    # one weight's slope by a small step of it
    codes, y = toxic_cnn.coded_words([r[0].encode() for r in data]), np.array([r[1] for r in data])
    x, _ = toxic_cnn.pooled(toxic_cnn.embed(*codes[:2], model[0]), codes[2], model)

    def likelihood(step):
        p = toxic_cnn.probability(x, (*model[:2], model[2] + step * np.eye(len(model[2]))[0], model[3]))
        return (y * np.log(p) + (1 - y) * np.log(1 - p)).sum()

    assert toxic_cnn.unpacked(found[0])[2][0] == pytest.approx((likelihood(1e-4) - likelihood(-1e-4)) / 2e-4, rel=1e-3)
