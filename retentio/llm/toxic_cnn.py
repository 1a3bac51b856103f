"""Toxicity by a convolutional text classifier in numpy.

Words are hashed (whole word, and its first four to eight bytes) into embedding
tables whose rows add up.  Filters of several widths slide over the words of
the whole text, the largest response of each is kept (max pooling), and a
logistic layer with weights of at least 0 gives the score: a response is evidence
for toxicity or none, so that a long text's many words can't outvote it.

Fit.  All labelled documents whose crc32 mod 5 is not 0, whole, whatever their
number and length.  The first coordinates of the tables start at the log odds
with which a hashed feature occurs in toxic texts, from counts over all rows.
Tables and filters then take ``ROUNDS`` Adagrad steps; each task adds up the
gradient of its rows and Spark sums them, so that a step sees every row.  Last,
the logistic layer is fitted by MLlib on the pooled responses of all rows.  Only
counts and gradients as large as the model reach the driver.  Labels, lang,
source and doc_id are no inputs of a score.

Thresholds.  ``predicted`` is score >= 0.5.  Beside it, ``flagged`` uses a
threshold for the document's language: the middle of the scores that separate
the classes best by F1 on a fifth of the fit rows, scored by a model fitted on
the other four in the same passes; a language never seen there uses 0.5.

Defined cases: null or empty text has no words and gets the score of an empty
pool; without labels of both classes every score is 0; very long texts are
fitted and scored whole; extra columns are not read; repeated rows each get a row; labels whose doc_id has no document are
not used.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import DenseMatrix
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retentio.llm.common import byte_slices, held_out_expr, ship_package, text_bytes
from retentio.llm.words import Words, bucket, head_hashes
from retentio.session import written_table

BITS = 15
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
ROUNDS = 5  # gradient steps of the filters, each over all rows
RIDGE = 1e-3  # of the output layer
FIXED = 24  # bits behind the point of a summed gradient
CELLS = 1 << 20  # parts of the score's range in which thresholds are looked for
HELD_BACK = 5  # a fifth of the fit rows, by a hash of doc_id, calibrates the thresholds
PRIOR = 20  # texts of the common share that each feature's odds start from
RATE = 0.1
PREFIXES = (4, 5, 6, 7, 8)  # bytes
TABLES = 1 + len(PREFIXES)


def coded_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(table rows of each different word, which of them each word is, words of each text).

    A word's rows (TABLES of them) are those of the hashed word and its
    prefixes.  Words are told apart by their hash; if two words of different
    first bytes share one, every word stands for itself.
    """
    import pyarrow as pa
    words = Words(texts)
    whole, heads = words.hashes(), words.heads()
    found = pa.array(whole).dictionary_encode()
    which = found.indices.to_numpy(zero_copy_only=False)
    first = np.empty(len(found.dictionary), dtype=np.int64)
    first[which[::-1]] = np.arange(len(which) - 1, -1, -1)
    if (np.take(heads[first], which) != heads).any():
        which = first = np.arange(len(which))
    whole, heads = whole[first], heads[first]
    rows = np.empty((len(first), TABLES), dtype=np.int32)
    for k in range(TABLES):
        rows[:, k] = bucket(head_hashes(heads, PREFIXES[k - 1]) if k else whole, BITS) + (k << BITS)
    return rows, which, words.per_text


def embed(rows: np.ndarray, which: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Embedding of every word, from :func:`coded_words`."""
    out = np.take(table, rows[:, 0], axis=0)  # much faster than an index
    for k in range(1, rows.shape[1]):
        out += np.take(table, rows[:, k], axis=0)
    return np.take(out, which, axis=0)


def responses(vectors: np.ndarray, bank: np.ndarray, width: int) -> np.ndarray:
    """Filter responses of every window that starts at a word (zeros after the last)."""
    n = len(vectors)
    out = vectors @ bank[0]
    for k in range(1, width):
        out[:n - k] += vectors[k:] @ bank[k]
    return out


def pooled(vectors: np.ndarray, per_text: np.ndarray, model, where: bool = False):
    """Largest response of each filter in each text (0 in an empty text), and its place."""
    _, banks, _, _ = model
    used = np.flatnonzero(per_text)
    ends = np.cumsum(per_text)
    starts = (ends - per_text)[used]
    best = np.zeros((len(per_text), len(WIDTHS) * FILTERS), dtype=np.float32)
    place = np.zeros(best.shape, dtype=np.int64)
    if not len(used):
        return best, place
    for b, width in enumerate(WIDTHS):
        r = responses(vectors, banks[b], width)
        # a window must not run into the next text
        for k in range(1, width):
            late = ends[used] - k
            late = late[late > starts]
            r[late] = -1e9
        # a text of fewer words has one window, with nothing behind its words
        short = per_text[used] < width
        at, size = starts[short], per_text[used][short]
        own = vectors[at] @ banks[b][0]
        for k in range(1, width - 1):
            own[size > k] += vectors[at[size > k] + k] @ banks[b][k]
        r[at] = own
        cols = slice(b * FILTERS, (b + 1) * FILTERS)
        best[used, cols] = np.maximum.reduceat(r, starts, axis=0)
        if where:
            for d, s in zip(used, starts):
                place[d, cols] = s + r[s:ends[d]].argmax(axis=0)
    return best, place


def probability(x: np.ndarray, model) -> np.ndarray:
    _, _, weight, bias = model
    return 1.0 / (1.0 + np.exp(-np.clip(np.maximum(x, 0) @ weight + bias[0], -30, 30)))


def different(values: np.ndarray) -> np.ndarray:
    """Each value once, ascending."""
    values = np.sort(values)
    return values[np.diff(values, prepend=-1) != 0] if len(values) else values


def feature_counts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text, table row) of every feature that occurs in a text, once each."""
    rows, which, per_text = coded_words(texts)
    who = np.repeat(np.arange(len(texts)), per_text)
    n, size = max(len(rows), 1), TABLES << BITS
    who, word = np.divmod(different(who * n + which), n)
    pairs = different((who[:, None] * size + rows[word]).ravel())
    return pairs // size, pairs % size


def initial_model(in1: np.ndarray, in0: np.ndarray, n1: int, n0: int, seed: int = 42):
    """Model whose table starts at the log odds of each feature, given in how many texts of a class it occurs."""
    rng = np.random.default_rng(seed)
    size = TABLES << BITS
    odds = np.zeros(size)
    part = (np.log(in1 / max(n1, 1) + PRIOR / max(n1 + n0, 1))
            - np.log(in0 / max(n0, 1) + PRIOR / max(n1 + n0, 1)))
    known = in1 + in0 > 0
    odds[known] = np.clip(part[known], -4, 4)
    table = rng.normal(0, 0.05, (size, DIM)).astype(np.float32)
    table[:, 0] = odds / 4
    for k in range(TABLES):
        own = slice(k << BITS, (k + 1) << BITS)
        table[own, 1 + k] = odds[own] / 4
    banks = [rng.normal(0, 0.2, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    for b in banks:
        b[0, np.arange(TABLES + 1), np.arange(TABLES + 1)] = 1.0
    return table, banks, np.full(len(WIDTHS) * FILTERS, 0.1), np.array([-1.0])


def add_gradients(code, toxic: np.ndarray, model, total: np.ndarray) -> None:
    """Adds the gradient of the log likelihood of some :func:`coded_words` to ``total`` (laid out as :func:`packed`)."""
    table, banks, weight, _ = model
    rows, which, n = code
    ends = np.cumsum(n)
    v = embed(rows, which, table)
    x, place = pooled(v, n, model, where=True)
    gap = toxic - probability(x, model)
    down = gap[:, None] * weight[None, :] * (x > 0) * (n > 0)[:, None]
    of_table, of_banks, of_weight, of_bias = unpacked(total)
    cells = of_table.reshape(-1)  # a view
    for b, width in enumerate(WIDTHS):
        cols = slice(b * FILTERS, (b + 1) * FILTERS)
        g, at = down[:, cols], place[:, cols]
        for k in range(width):
            inside = at + k < ends[:, None]
            src = np.minimum(at + k, max(len(v) - 1, 0))
            if not len(v):
                continue
            of_banks[b][k] += np.einsum("df,dfe->ef", g, v[src] * inside[:, :, None])
            # embeddings of the words that won the pool
            flat = ((g * inside)[:, :, None] * banks[b][k].T[None]).reshape(-1, DIM)
            hit = np.flatnonzero(np.abs(flat).sum(axis=1))
            won, added = rows[which[src.ravel()[hit]]], flat[hit].ravel()
            for c in range(TABLES):
                np.add.at(cells, (won[:, c, None].astype(np.int64) * DIM + np.arange(DIM)).ravel(), added)
    of_weight += np.maximum(x, 0).T @ gap
    of_bias += gap.sum()


PACKED = [(TABLES << BITS, DIM), *[(w, DIM, FILTERS) for w in WIDTHS], (len(WIDTHS) * FILTERS,), (1,)]


def packed(model) -> np.ndarray:
    """All parameters in one row of numbers."""
    table, banks, weight, bias = model
    return np.concatenate([np.asarray(p, dtype=np.float64).ravel() for p in (table, *banks, weight, bias)])


def unpacked(flat: np.ndarray):
    """(table, banks, weight, bias) as views of a row of numbers."""
    cuts = np.cumsum([int(np.prod(s)) for s in PACKED])[:-1]
    parts = [p.reshape(s) for p, s in zip(np.split(flat, cuts), PACKED)]
    return parts[0], parts[1:1 + len(WIDTHS)], parts[-2], parts[-1]


def as_model(flat: np.ndarray):
    table, banks, weight, bias = unpacked(flat)
    return table.astype(np.float32), [b.astype(np.float32) for b in banks], weight.copy(), bias.copy()


def score_texts(texts: list[bytes], model) -> np.ndarray:
    """Scores of whole texts."""
    out = np.zeros(len(texts))
    if model is None:
        return out
    for i, j in byte_slices(texts):
        rows, which, per_text = coded_words(texts[i:j])
        x, _ = pooled(embed(rows, which, model[0]), per_text, model)
        out[i:j] = probability(x, model)
    return out


def calibrate(scores: np.ndarray, toxic: np.ndarray) -> float:
    """Threshold in the middle of the gap that gives the best F1."""
    order = np.argsort(-scores, kind="stable")
    s, y = scores[order], toxic[order]
    if not y.any() or y.all():
        return 0.5
    f1 = 2 * np.cumsum(y) / (np.arange(1, len(y) + 1) + y.sum())
    f1[:-1][s[:-1] == s[1:]] = -1  # no cut between equal scores
    k = int(f1.argmax())
    return float((s[k] + s[k + 1]) / 2) if k + 1 < len(s) else float(s[k])


def fit_table(docs: DataFrame, labels: DataFrame, n_toxic: int | None = None, n_clean: int | None = None) -> DataFrame:
    """(doc_id, text, lang, toxic, back) of every labelled document outside the held-out part, written once.

    A doc_id that occurs more than once gives its smallest row and label.
    Limits are for callers that want fewer rows: the first by a hash of doc_id.
    """
    own = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out_expr())
    own = own.select("doc_id", "toxic")
    if n_toxic is not None or n_clean is not None:
        order = [F.xxhash64(F.lit(42), "doc_id"), F.col("doc_id")]
        parts = [own.where(F.col("toxic") == v).select("doc_id").distinct().orderBy(*order).limit(n)
                 if n is not None else own.where(F.col("toxic") == v).select("doc_id")
                 for v, n in ((1, n_toxic), (0, n_clean))]
        own = own.join(parts[0].unionAll(parts[1]).distinct(), "doc_id", "left_semi")
    own = own.groupBy("doc_id").agg(F.min("toxic").alias("toxic"))
    rows = docs.select("doc_id", "text", "lang").join(own, "doc_id").groupBy("doc_id").agg(
        F.min(F.struct("text", "lang")).alias("row"), F.min("toxic").alias("toxic"))
    back = F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(HELD_BACK)) == 0
    return written_table(rows.select("doc_id", "row.text", "row.lang", "toxic", back.alias("back")))


def _each_slice(batches):
    """(texts, toxic, back) of slices of (text, toxic, back) batches."""
    for b in batches:
        texts, toxic = text_bytes(b.column(0)), b.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
        back = b.column(2).to_numpy(zero_copy_only=False).astype(bool)
        for i, j in byte_slices(texts):
            yield texts[i:j], toxic[i:j], back[i:j]


def _class_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Texts that hold each feature, by (class, held back), and the texts of each; summed by Spark."""
    size = TABLES << BITS

    def run(batches):
        import pyarrow as pa
        total = np.zeros((4, size + 1), dtype=np.int64)  # last column: the texts themselves
        for texts, toxic, back in _each_slice(batches):
            kind = (toxic * 2 + back).astype(np.int64)
            who, feature = feature_counts(texts)
            total += np.bincount(kind[who] * (size + 1) + feature, minlength=4 * (size + 1)).reshape(4, -1)
            total[:, size] += np.bincount(kind, minlength=4)
        at = np.flatnonzero(total.any(axis=0))
        yield pa.record_batch([pa.array(at), *[pa.array(total[k, at]) for k in range(4)]],
                              names=["at", "k0", "k1", "k2", "k3"])

    kinds = [f"k{k}" for k in range(4)]
    found = (rows.select("text", "toxic", "back").mapInArrow(run, "at long, k0 long, k1 long, k2 long, k3 long")
             .groupBy("at").agg(*[F.sum(k).alias(k) for k in kinds]).toArrow())  # at most the table's rows
    out = np.zeros((4, size + 1), dtype=np.int64)
    for k in range(4):
        out[k, found["at"].to_numpy()] = found[kinds[k]].to_numpy()
    return out[:, :size], out[:, size]


def _gradient_sums(rows: DataFrame, models: list) -> list[np.ndarray]:
    """Gradients of the models over all rows (the second model's without those held back); summed by Spark.

    Tasks hand on whole numbers of 2**-``FIXED``, so that the sums don't depend on their order,
    in lines of ``DIM`` parameters, where one is not 0.
    """
    shared = rows.sparkSession.sparkContext.broadcast(models)
    size = int(sum(np.prod(s) for s in PACKED))
    lines, sums = -(-size // DIM), [f"g{k}" for k in range(DIM)]

    def run(batches):
        import pyarrow as pa
        totals = [np.zeros(size) for _ in shared.value]
        for texts, toxic, back in _each_slice(batches):
            code = coded_words(texts)
            for m, model in enumerate(shared.value):
                use = ~back if m else np.ones(len(texts), dtype=bool)
                if use.any():
                    own = (code[0], code[1][np.repeat(use, code[2])], code[2][use])
                    add_gradients(own, toxic[use], model, totals[m])
        for m, t in enumerate(totals):
            whole = np.zeros((lines, DIM), dtype=np.int64)
            whole.reshape(-1)[:size] = np.rint(t * 2.0 ** FIXED)
            at = np.flatnonzero(whole.any(axis=1))
            yield pa.record_batch([pa.array(np.full(len(at), m, dtype=np.int32)), pa.array(at.astype(np.int32)),
                                   *[pa.array(whole[at, k]) for k in range(DIM)]], names=["m", "at", *sums])

    found = (rows.select("text", "toxic", "back").mapInArrow(run, "m int, at int, " + ", ".join(f"{c} long" for c in sums))
             .groupBy("m", "at").agg(*[F.sum(c).alias(c) for c in sums]).toArrow())  # at most the models' parameters
    shared.destroy()
    which, at = found["m"].to_numpy(), found["at"].to_numpy()
    g = np.column_stack([found[c].to_numpy() for c in sums])
    out = []
    for m in range(len(models)):
        total = np.zeros((lines, DIM))
        total[at[which == m]] = g[which == m] / 2.0 ** FIXED
        out.append(total.reshape(-1)[:size])
    return out


def _pooled_table(rows: DataFrame, models: list) -> DataFrame:
    """(lang, toxic, back, x0, x1): pooled responses of each text under each model, written."""
    shared = rows.sparkSession.sparkContext.broadcast(models)

    def run(batches):
        import pyarrow as pa
        for b in batches:
            texts = text_bytes(b.column(3))
            out = [[np.zeros((0, len(WIDTHS) * FILTERS))] for _ in shared.value]
            for i, j in byte_slices(texts):
                rows, which, per_text = coded_words(texts[i:j])
                for m, model in enumerate(shared.value):
                    out[m].append(np.maximum(pooled(embed(rows, which, model[0]), per_text, model)[0], 0))
            yield pa.record_batch([*b.columns[:3], *[pa.array(list(np.concatenate(o).astype(np.float64))) for o in out]],
                                  names=["lang", "toxic", "back", "x0", "x1"])

    return written_table(rows.select("lang", "toxic", "back", "text").mapInArrow(
        run, "lang string, toxic int, back boolean, x0 array<double>, x1 array<double>"))


def _output_layer(pools: DataFrame, column: str) -> tuple[np.ndarray, np.ndarray]:
    """(weights of at least 0, bias) of the logistic layer over all rows, by MLlib."""
    data = pools.select(array_to_vector(F.col(column)).alias("features"), F.col("toxic").cast("double").alias("label"))
    width = len(WIDTHS) * FILTERS
    model = LogisticRegression(regParam=RIDGE, standardization=False, maxIter=60, tol=1e-7,
                               lowerBoundsOnCoefficients=DenseMatrix(1, width, [0.0] * width)).fit(data)
    return np.array(model.coefficients.toArray()), np.array([model.intercept])


def _threshold_table(held: DataFrame, layer) -> dict:
    """Threshold of each language over all held-back rows; scores are counted in ``CELLS`` equal cells."""
    weight, bias = layer
    dot = F.aggregate(F.zip_with("x1", F.array(*[F.lit(float(w)) for w in weight]), lambda a, b: a * b),
                      F.lit(float(bias[0])), lambda s, v: s + v)
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-dot))
    cells = (held.groupBy(F.coalesce("lang", F.lit("")).alias("lang"), F.floor(score * CELLS).alias("cell"))
             .agg(F.sum("toxic").alias("pos"), F.count("*").alias("n")))
    down = Window.partitionBy("lang").orderBy(F.col("cell").desc())
    run = cells.select(
        "lang", "cell", F.lead("cell").over(down).alias("below"), F.sum("pos").over(down).alias("tp"),
        F.sum("n").over(down).alias("taken"), F.sum("pos").over(Window.partitionBy("lang")).alias("pos"),
        F.sum("n").over(Window.partitionBy("lang")).alias("n"))
    f1 = F.lit(2.0) * F.col("tp") / (F.col("taken") + F.col("pos"))
    mid = (F.col("cell") + F.coalesce("below", F.col("cell")) + F.lit(1.0)) / F.lit(2.0 * CELLS)
    best = (run.groupBy("lang").agg(F.max(F.struct(f1.alias("f1"), F.col("cell"), mid.alias("mid"))).alias("b"),
                                    F.max("pos").alias("pos"), F.max("n").alias("n"))
            .select("lang", F.when((F.col("pos") == 0) | (F.col("pos") == F.col("n")), 0.5)
                    .otherwise(F.col("b.mid")).alias("t")))
    return {r["lang"]: float(r["t"]) for r in best.collect()}


def fit(docs: DataFrame, labels: DataFrame, n_toxic: int | None = None, n_clean: int | None = None):
    """(model, thresholds by language) from all labelled rows outside the held-out part."""
    ship_package(docs.sparkSession)
    rows = fit_table(docs, labels, n_toxic, n_clean)
    counts, sizes = _class_counts(rows)
    if not (sizes[2] + sizes[3] and sizes[0] + sizes[1]):
        return None, {}
    # all rows, and all but those held back for the thresholds
    models = [initial_model(counts[2] + counts[3], counts[0] + counts[1], sizes[2] + sizes[3], sizes[0] + sizes[1]),
              initial_model(counts[2], counts[0], sizes[2], sizes[0])]
    n = [int(sizes.sum()), max(int(sizes[0] + sizes[2]), 1)]
    flat = [packed(m) for m in models]
    power = [np.full(len(f), 1e-8) for f in flat]
    for round_ in range(ROUNDS):
        for m, g in enumerate(_gradient_sums(rows, [as_model(f) for f in flat])):
            g /= n[m]
            power[m] += g * g
            flat[m] += RATE / (1 + round_) ** 0.5 * g / np.sqrt(power[m])
            np.maximum(unpacked(flat[m])[2], 0, out=unpacked(flat[m])[2])
    models = [as_model(f) for f in flat]
    pools = _pooled_table(rows, models)
    thresholds = {}
    if sizes[0] and sizes[2]:
        thresholds = _threshold_table(pools.where("back"), _output_layer(pools.where("not back"), "x1"))
    return (*models[0][:2], *_output_layer(pools, "x0")), thresholds


def toxicity_table(docs: DataFrame, fitted) -> DataFrame:
    """(doc_id, held_out, score, predicted, flagged) of every row."""
    model, thresholds = fitted
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.record_batch([b.column(0), b.column(1), b.column(2),
                                   pa.array(score_texts(text_bytes(b.column(3)), shared.value))],
                                  names=["doc_id", "held_out", "lang", "score"])

    scored = docs.select("doc_id", held_out_expr().alias("held_out"), "lang", "text").mapInArrow(
        run, "doc_id long, held_out boolean, lang string, score double")
    limit = F.lit(0.5)
    for lang, t in thresholds.items():
        limit = F.when(F.coalesce("lang", F.lit("")) == lang, F.lit(t)).otherwise(limit)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                         (F.col("score") >= limit).alias("flagged"))
