"""Clashing column names, repeated and conflicting labels, odd roles, and linking against a plain version."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

import corpus_pipeline
from retentio.llm import chat_fsm, poisson_mix, quality_crf, secret_links, simhash_ring, toxic_cnn
from retentio.llm.common import training_rows


def test_roles_come_back_whatever_they_hold(spark):
    roles = ["user", "a\\b", "a\\\\n", "x\ny", "\\n", "\u0000", "\\\u0000\\", "<|im_end|>", "<\\|", "\\", ""]
    rows = spark.createDataFrame([(1, k, r, f"t{k}") for k, r in enumerate(roles)],
                                 "conv_id long, turn long, role string, text string")
    out = chat_fsm.format_conversations(rows).select(
        chat_fsm.parse_text(chat_fsm.formatted_text(F.col("segments"))).alias("t")).first().t
    assert [r.role for r in out] == roles
    assert [r.text for r in out] == [f"t{k}" for k in range(len(roles))]


def test_training_rows_take_each_column_from_its_table(spark):
    docs = spark.createDataFrame([(1, "own", "en", 9), (1, "own", "en", 9), (2, None, "de", 9), (3, "three", None, 9),
                                  (None, "none", "en", 9)], "doc_id long, text string, lang string, toxic int")
    labels = spark.createDataFrame([(1, 1, "other", "xx"), (1, 1, "other", "xx"), (2, 0, "other", "xx"),
                                    (2, 1, "other", "xx"), (3, None, "o", "x"), (7, 1, "absent", "x"), (None, 1, "n", "x")],
                                   "doc_id long, toxic int, text string, lang string")
    got = training_rows(docs, ["text", "lang"], 10, labels, "toxic", F.col("toxic").isNotNull())
    assert [tuple(r) for r in got] == [(1, "own", "en", 1), (2, None, "de", 0)]
    assert [tuple(r) for r in training_rows(docs, ["text"], 2, condition=F.col("text").isNotNull())] == [
        (k, t) for k, t in ((1, "own"), (3, "three"))]
    assert training_rows(docs, ["text"], 10, labels.limit(0), "toxic") == []


def test_models_ignore_columns_of_the_other_table(spark, documents, labels):
    strange = labels.withColumn("text", F.lit("x")).withColumn("lang", F.lit("x"))
    crowded = documents.withColumn("quality", F.lit(5)).withColumn("toxic", F.lit(5))
    a, b = quality_crf.fit(documents, labels, 60), quality_crf.fit(crowded, strange, 60)
    assert all((x == y).all() for x, y in zip(a, b))
    odd = labels.withColumn("quality", F.when(F.col("quality") == 0, 7).otherwise(F.col("quality")))
    assert quality_crf.fit(documents, odd, 60)[1].tolist() == [[0, 0], [0, 0]]  # one class left
    model, limits = toxic_cnn.fit(crowded, strange, 20, 40)
    want, same = toxic_cnn.fit(documents, labels, 20, 40)
    assert limits == same and "x" not in limits and (model[2] == want[2]).all()


def test_mix_keeps_columns_that_clash(spark, documents):
    names = ("copy_no", "MIX_KEY", "mix_unit", "n_copies", "rate_source", "rate_cdf")
    crowded = documents.select("*", *[F.lit("x").alias(n) for n in names])
    plain = {(r.doc_id, r.copy_no, r.mix_key) for r in poisson_mix.mix(documents).collect()}
    out = poisson_mix.mix(crowded)
    assert {(r.doc_id, r.copy_no, r.mix_key) for r in out.collect()} == plain
    assert [n.lower() for n in out.columns].count("mix_key") == 1
    assert out.where("mix_unit = 'x' and n_copies = 'x' and rate_source = 'x' and rate_cdf = 'x'").count() == len(plain)
    staged = corpus_pipeline.mixing(spark, crowded, "")
    assert staged.columns == crowded.columns
    assert staged.where("copy_no = 'x' and mix_key = 'x'").count() == len(plain)


def plain_links(text, base):
    """All pairs of parts, one by one."""
    meets = lambda a, b: any(a < y and x < b for x, y, _ in base)
    ids = [s for s in base if s[2] == "access"] + [
        (m.start(1), m.end(1), "ident") for m in secret_links.IDENT.finditer(text) if not meets(m.start(1), m.end(1))]
    places = {s[:2] for s in ids}
    values = [s for s in base if s[2] in ("assign", "hex")] + [
        (m.start(), m.end(), "value") for m in secret_links.VALUE.finditer(text)
        if secret_links._random_looking(m.group()) and (m.start(), m.end()) not in places and not meets(m.start(), m.end())]

    def near(s, o):
        a, b = min(s[1], o[1]), max(s[0], o[0])
        return s[:2] != o[:2] and b - a <= secret_links.SCOPE and "\n\n" not in text[a:b]
    pairs = [(i, v) for i in ids for v in values if near(i, v)]
    chosen = {s for p in pairs for s in p}
    scopes = [(min(i[0], v[0]), max(i[1], v[1])) for i, v in pairs]
    scopes += [s[:2] for s in base if s[2] != "hex"]
    for m in secret_links.ENDPOINT.finditer(text):
        s = (m.start(), m.end(), "endpoint")
        if not meets(*s[:2]) and any(near(s, p) for p in scopes):
            chosen.add(s)
    return sorted(s for s in chosen if s[2] in ("ident", "value", "endpoint"))


PARTS = ["AKIA" + "Q7" * 8, "client_id=abc-123.x", "account_id: 99887766", "wJalrXUtnFEMIK7MDENGbPxRfi", "0a1b" * 9,
         "password=hunter2hunter2", "token: " + "ab12" * 40, "https://db.example.org/x?y=1", "s3.eu.amazonaws.com",
         "user_id=" + "0a" * 20, "\n\n", "\n", "plain words between", "word " * 60]


def test_links_equal_all_pairs():
    rng = random.Random(5)
    seen = set()
    for _ in range(300):
        text = " ".join(rng.choice(PARTS) for _ in range(rng.randint(1, 25)))
        base = sorted(secret_links.base_spans(text))
        got = sorted(secret_links.linked_spans(text, base))
        assert got == plain_links(text, base)
        seen |= {s[2] for s in got}
    assert seen == {"ident", "value", "endpoint"}


def test_long_text_full_of_parts():
    """A span of 1 MB beside 40,000 parts: neighbours come from binary searches."""
    part = "client_id=abc123 wJalrXUtnFEMIK7MDENGbPxRfi " + "0123abcd" * 4 + " plain words here\n\n"
    text = "0a" * 500_000 + " " + part * 20_000
    base, spans = secret_links.scan(text)
    assert len(base) == 20_001 and len(spans) == len(base) + 40_000


TEXT_A = "the quick brown fox jumps over the lazy dog while the cat sleeps " * 6
TEXT_B = "entirely different words about ships harbours storms and lighthouses " * 6
TEXT_C = "a third text on gardens seeds watering cans and patient gardeners here " * 6


def test_deduplicate_tells_rows_of_one_id_by_their_texts(spark):
    """A unique text under a repeated id stays, in whatever order the rows come."""
    rows = [(3, TEXT_A, "x"), (5, TEXT_A, "y"), (5, TEXT_B, "y"), (5, TEXT_C, "z"), (8, TEXT_C, "w"),
            (5, TEXT_B, "b"), (5, TEXT_B.upper(), "u"), (None, TEXT_A, "n"), (9, None, "v"), (10, "", "v")]
    seen = set()
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        docs = spark.createDataFrame(order, "doc_id long, text string, source string").withColumn("root", F.lit(1))
        out = simhash_ring.deduplicate(docs)
        assert out.columns == docs.columns
        seen.add(tuple(sorted(((r.doc_id, r.text, r.source) for r in out.collect()), key=str)))
    assert len(seen) == 1
    kept = seen.pop()
    assert {(i, t.lower() if t else t) for i, t, _ in kept} == {
        (3, TEXT_A.lower()), (5, TEXT_B.lower()), (5, TEXT_C.lower()), (None, TEXT_A.lower()), (9, None)}
    assert len(kept) == 5


def test_pipeline_stage_keeps_unlinked_texts_of_one_id(spark):
    docs = spark.createDataFrame([(3, TEXT_A), (5, TEXT_A), (5, TEXT_B)], "doc_id long, text string")
    assert {tuple(r) for r in corpus_pipeline.near_dedup(spark, docs, "").collect()} == {(3, TEXT_A), (5, TEXT_B)}


def test_deduplicate_groups_no_text_that_occurs_once(spark):
    """Whole rows that occur once are joined, not aggregated; repeats still give one row."""
    rows = [(k, f"own text number {k} " + f"w{k} x{k} y{k} " * 9, "s") for k in range(1, 40)]
    docs = spark.createDataFrame([*rows, rows[4], rows[4], (3, rows[2][1], "t")], "doc_id long, text string, source string")
    out = simhash_ring.deduplicate(docs)
    kept = out.collect()
    assert sorted(r.doc_id for r in kept) == list(range(1, 40))
    assert {tuple(r) for r in kept} <= {*rows, (3, rows[2][1], "t")}
    parts = out._jdf.queryExecution().optimizedPlan().children()
    plans = [parts.apply(k).toString() for k in range(parts.size())]
    assert any("Join" in p and "Aggregate" not in p for p in plans)
