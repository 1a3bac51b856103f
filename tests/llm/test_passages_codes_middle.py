"""Phrase automata, cover-tree codes and fill-in-middle against plain brute force."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from retentio.llm import cover_codes, fill_middle, phrase_automata


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- op11 ----------------------------------------------------------------------------------

def brute_passages(rows, window):
    words = [(d, (t or "").encode().split()) for d, t in rows]
    first = {}
    for d, w in words:
        for k in range(len(w) - window + 1) if d is not None else ():
            key = tuple(w[k:k + window])
            first[key] = min(d, first.get(key, d))
    out = []
    for d, w in words:
        cut = [False] * len(w)
        for k in range(len(w) - window + 1) if d is not None else ():
            if first[tuple(w[k:k + window])] < d:
                cut[k:k + window] = [True] * window
        kept = [x for x, c in zip(w, cut) if not c]
        out.append((d, len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


def found_passages(docs, **how):
    rows = phrase_automata.repeated_passages(docs, **how).collect()
    for r in rows:
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows), key=str)


@pytest.mark.parametrize("hot", [500, 2])
def test_passages_equal_brute_force(documents, hot):
    want = brute_passages([(r.doc_id, r.text) for r in documents.collect()], 50)
    assert sum(r[2] for r in want) > 1000
    assert found_passages(documents, hot=hot) == want


def passage_rows():
    """Overlapping, shifted, nested and repeated passages over a small vocabulary."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(400)}" for _ in range(900)]
    rows = []
    for d in range(60):
        text = []
        for _ in range(rng.randrange(1, 6)):
            a, n = rng.randrange(800), rng.choice([5, 9, 10, 11, 12, 25, 60, 300])
            text += base[a:a + n] + [f"own{rng.randrange(50)}" for _ in range(rng.randrange(3))]
        rows.append((rng.randrange(50), rng.choice([" ", "\n", "  "]).join(text)))
    rows += [(70, "same " * 500), (71, "same " * 700), (72, "a b " * 300), (73, "b a " * 200), (69, "same " * 9)]
    return rows + [(None, rows[0][1]), (74, rows[0][1]), (74, rows[0][1]), (74, rows[1][1] + " x"), (75, None), (76, "")]


@pytest.mark.parametrize("hot,window,gram", [(500, 10, 4), (1, 10, 4), (3, 12, 6), (500, 10, 1)])
def test_passages_of_shifted_and_repeated_texts(spark, hot, window, gram):
    rows = passage_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found_passages(docs, window=window, gram=gram, hot=hot) == brute_passages(rows, window)


def test_passages_of_odd_rows(odd_extra, empty):
    rows = [(r.doc_id, r.text) for r in odd_extra.collect()]
    assert found_passages(odd_extra) == brute_passages(rows, 50)
    assert found_passages(empty) == []
    assert phrase_automata.remove_passages(odd_extra).columns == odd_extra.columns


def test_removed_passages_leave_the_kept_words(documents):
    found = {r.doc_id: r for r in phrase_automata.repeated_passages(documents).collect()}
    before = {r.doc_id: r.text for r in documents.collect()}
    for r in phrase_automata.remove_passages(documents).collect():
        if found[r.doc_id].n_removed:
            assert sha(r.text) == found[r.doc_id].kept_sha256
        else:
            assert r.text == before[r.doc_id]


def test_word_codes_of_long_texts_are_cut_between_words(monkeypatch):
    texts = [b"", b"one two  three", b"x" * 200 + b" y", "ü 中文 z".encode(), b" \t lead and trail \n"]
    whole = phrase_automata.word_codes(texts)
    monkeypatch.setattr(phrase_automata, "CHUNK", 7)
    cut = phrase_automata.word_codes(texts)
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()
    assert whole[1].tolist() == [len(t.split()) for t in texts]


def test_shards_find_what_one_automaton_finds():
    rng = random.Random(5)
    words = [f"w{rng.randrange(60)}" for _ in range(3000)]
    passages = [(d, " ".join(words[a:a + 80])) for d, a in enumerate(rng.sample(range(2900), 40))]
    doc = " ".join(words[100:2500]).encode()
    one = phrase_automata.removed_spans([(99, doc, passages)], 20)
    parts = []
    for shard in phrase_automata.shards(passages, 20, limit=200):
        parts += shard.runs(doc.split(), 99)
    assert phrase_automata.merged(parts) == one[0] != []


# --- op12 ----------------------------------------------------------------------------------

def brute_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    kept = sorted((r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])),
                  key=lambda r: (r[0], r[1]))
    vectors = [[math.floor(scale * float(x)) for x in v] for _, v, _ in kept]
    width = len(vectors[0]) // parts
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for v in vectors]
    books = [[cut[k][p] for k in range(min(entries, len(cut)))] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            mine = [nearest(c[p], books[p])[1] for c in cut]
            for k in range(len(books[p])):
                of = [c[p] for c, m in zip(cut, mine) if m == k]
                if of:
                    books[p][k] = [sum(x) // len(of) for x in zip(*of)]
    best = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    out = [(r[0], "".join(f"{k:02x}" for _, k in b), sum(d for d, _ in b), r[2]) for r, b in zip(kept, best)]
    return out, [x for book in books for e in book for x in e]


VECTORS = "vec_id long, embedding array<double>, label int"


def vector_rows():
    rng = np.random.default_rng(2)
    rows = [(int(k), [float(x) for x in rng.normal(0, 0.2, 16)], int(k) % 3 or None) for k in rng.permutation(200)]
    same = rows[7][1]
    rows += [(300 + k, same, 1) for k in range(60)] + [(5, same, None), (5, rows[1][1], 2), (5, rows[1][1], 2)]
    rows += [(400, None, 1), (401, [float("nan")] * 16, 1), (402, [None] + same[1:], 1), (403, [], 1),
             (404, [float("-inf")] + same[1:], 1), (405, [0.0] * 16, 9), (406, [-1e-9] * 16, 9), (407, [3.5] * 16, 9)]
    return rows


@pytest.mark.parametrize("block", [4096, 13])
def test_codes_equal_brute_force(spark, block):
    rows = vector_rows()
    frame = spark.createDataFrame(rows, VECTORS).withColumn("code", F.lit("x")).repartition(3)
    coded, books = cover_codes.encode_vectors(frame, block=block)
    want, flat = brute_codes(rows)
    assert books.reshape(-1).tolist() == flat
    got = cover_codes.with_label_error(coded).collect()
    total = {}
    for _, _, error, label in want:
        total[label] = total.get(label, 0) + error
    assert sorted([(r.vec_id, r.code, r.error, r.label, r.label_error) for r in got], key=str) == sorted(
        [(*w, total[w[3]]) for w in want], key=str)


def test_codes_of_few_or_no_vectors_and_odd_lengths(spark):
    few = spark.createDataFrame([(2, [0.5] * 8, 1), (1, [-0.5] * 8, None)], VECTORS)
    coded, books = cover_codes.encode_vectors(few)
    assert books.shape == (8, 2, 1) and {r.code: r.error for r in coded.collect()} == {"00" * 8: 0, "01" * 8: 0}
    coded, _ = cover_codes.encode_vectors(few.limit(0))
    assert cover_codes.with_label_error(coded).collect() == []
    for bad in ([0.5] * 9, [0.5] * 16, [1e9] * 8):
        with pytest.raises(Exception, match="parts|exceeds"):
            cover_codes.encode_vectors(few.union(spark.createDataFrame([(3, bad, 1)], VECTORS)))


def test_label_sums_joined_by_shuffle(spark, monkeypatch):
    coded, _ = cover_codes.encode_vectors(spark.createDataFrame(vector_rows(), VECTORS))
    plain = sorted(map(str, cover_codes.with_label_error(coded).collect()))
    monkeypatch.setattr(cover_codes, "BROADCAST_LABELS", 0)
    assert sorted(map(str, cover_codes.with_label_error(coded).collect())) == plain


def test_cover_trees_hold_their_invariants():
    rng = np.random.default_rng(4)
    points = rng.normal(0, 300, (3, 700, 5)).astype(np.int64)
    points[1, 300:] = points[1, 0]
    points[2] //= 200
    tree = cover_codes.build_trees(points)
    flat = points.reshape(-1, 5)
    assert sorted(tree["order"]) == list(range(2100))
    for k in range(len(tree["start"])):
        members = tree["order"][tree["start"][k]:tree["end"][k]]
        gaps = np.sqrt(((flat[members] - flat[tree["centre"][k]]) ** 2).sum(axis=1))
        assert gaps.max() == pytest.approx(tree["radius"][k])
        kids = range(tree["child"][k], tree["child"][k] + tree["n_children"][k])
        if len(kids):
            assert tree["start"][kids[0]] == tree["start"][k] and tree["end"][kids[-1]] == tree["end"][k]
            centres = flat[tree["centre"][list(kids)]].astype(float)
            apart = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(axis=2))[~np.eye(len(kids), dtype=bool)]
            covered = max(tree["radius"][c] for c in kids)
            assert not len(apart) or apart.min() > covered


def test_equal_entries_go_to_the_lower_index():
    points = np.array([[[0], [5], [10], [5]]])
    books = np.array([[[0], [10], [10], [0]]])
    codes, error = cover_codes.block_codes(points, cover_codes.build_trees(points), books)
    assert codes[:, 0].tolist() == [0, 0, 1, 0] and error.tolist() == [0, 25, 0, 25]


# --- op13 ----------------------------------------------------------------------------------

def brute_middle(doc_id, text, rate=100, spm_rate=50):
    text = text or ""
    units, rest = [], text
    while rest:
        k = rest.find("\n") + 1 or len(rest)
        units.append(rest[:k])
        rest = rest[k:]
    n = len(units)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k:8 * k + 8], 16) for k in range(4))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    a, b = min(h1 % (n + 1), h2 % (n + 1)), max(h1 % (n + 1), h2 % (n + 1))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm_rate:
        return doc_id, n, "spm", len(p), len(m), "<S>" + s + "<P>" + p + "<M>" + m
    return doc_id, n, "psm", len(p), len(m), "<P>" + p + "<S>" + s + "<M>" + m


MIDDLES = [(k, t) for k, t in enumerate([
    "a\nb\nc", "\n\n\n", "one line", "", None, "x <P> y\n", "ends <\nS> <", "<S\n<M\n<P\n", "中\n\U0001f600\n\x0b\x85 x\n",
    "long\n" * 50_000, "y" * 300_000, "cr\r\nlf\r\n"] * 3)] + [(None, "no\nid\n"), (3, "twice\nhere"), (3, "twice\nhere")]


@pytest.mark.parametrize("rate,spm_rate", [(100, 50), (40, 0), (0, 50), (100, 100)])
def test_middles_equal_brute_force_and_come_back(spark, rate, spm_rate):
    docs = spark.createDataFrame([(*r, "x", 1) for r in MIDDLES], "doc_id long, text string, form string, n int")
    out = fill_middle.fill_in_middle(docs, rate=rate, spm_rate=spm_rate)
    got = out.withColumn("back", fill_middle.restored_text(F.col("output"), F.col("form"))).collect()
    want = [brute_middle(*r, rate, spm_rate) for r in MIDDLES]
    assert sorted([tuple(r)[:6] for r in got], key=str) == sorted(want, key=str)
    assert sorted((r.doc_id, r.back) for r in got if r.doc_id is not None) == sorted(
        (d, t or "") for d, t in MIDDLES if d is not None)


def test_middles_of_other_units_and_marks(spark, empty):
    docs = spark.createDataFrame([(1, "ab cd ef"), (2, "éé")], "doc_id long, text string")
    out = fill_middle.fill_in_middle(docs, unit=r"(?s:.)", marks=("[p]", "[s]", "[m]"))
    back = fill_middle.restored_text(F.col("output"), F.col("form"), ("[p]", "[s]", "[m]"))
    assert {r.doc_id: (r.n, r.back) for r in out.withColumn("back", back).collect()} == {
        1: (8, "ab cd ef"), 2: (2, "éé")}
    for marks in (("aba", "<S>", "<M>"), ("", "<S>", "<M>"), ("<P>", "<P>x", "<M>"), ("<P>", "<P>", "<M>")):
        with pytest.raises(ValueError):
            fill_middle.fill_in_middle(docs, marks=marks)
    assert fill_middle.fill_in_middle(empty).collect() == []
