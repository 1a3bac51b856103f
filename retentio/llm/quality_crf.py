"""Quality rules by line labelling with a linear-chain conditional random field.

Every line of a text is a position of a chain with two labels, content and
boilerplate.  Emission scores are linear in the line features, transitions
are learnt, and Viterbi decoding labels the lines.  The share of word
characters on content lines is the text's content share; a text that passes
the base rules is kept if the share reaches ``MIN_CONTENT``.

Base rules and counts (exact, whole text): words are runs of bytes outside
ASCII white space; see ``line_table`` for each count.

Fit.  Line labels are weak: all lines of a document with quality 0 count as
boilerplate and all lines of one with quality 1 as content, but a line text
that stands in documents of both kinds (shared passages, licence lines) and
blank lines are left unlabelled and are marginalised over.  At most
``FIT_ROWS`` labelled documents are used, chosen by a hash of doc_id.

Defined cases: null text has no words and fails the base rules, like any text
under ``MIN_WORDS`` words; without labels every line is content, so only the
base rules decide; repeated rows each get a row; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentio.llm.common import byte_slices, ship_package, text_bytes, training_rows

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_CONTENT = 0.5
RARE_ROWS = 200  # of a label that the fit's sample doesn't hold
FIT_ROWS = 2000
PIECE = 24  # lines of one training chain; longer texts give several chains

FEATURES = ("bias", "symbol_words", "symbols", "bars", "bangs", "upper", "digits", "adjacent_repeats",
            "repeated_windows", "few_words", "no_stop", "starts_lower", "blank", "repeated_line", "long_words")
BOILERPLATE, CONTENT = 0, 1

_CLASSES = {"space": b" \t\n\r\x0b\x0c", "symbol": b"#*$%&|<>", "bar": b"|", "bang": b"!",
            "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)), "digit": b"0123456789",
            "cont": bytes(range(0x80, 0xC0))}
_TABLES = {k: np.isin(np.arange(256), list(v)) for k, v in _CLASSES.items()}


class Lines:
    """Counts and features of the lines of a slice of texts; doc_of_line is ascending."""


def repeated_windows(ids: np.ndarray, doc: np.ndarray, base: int) -> np.ndarray:
    """Marks words inside 3-word windows that occur twice or more in their document."""
    n = len(ids)
    covered = np.zeros(n, dtype=bool)
    if n < 4:
        return covered
    same = doc[2:] == doc[:-2]
    n_docs = int(doc[-1]) + 1
    if n_docs * base ** 3 < 2 ** 63:
        key = ((doc[:-2] * base + ids[:-2]) * base + ids[1:-1]) * base + ids[2:]
    else:  # very long texts: number the pairs first
        _, pair = np.unique(ids[:-2] * base + ids[1:-1], return_inverse=True)
        _, triple = np.unique(pair.astype(np.int64) * base + ids[2:], return_inverse=True)
        key = doc[:-2] * (n + 1) + triple
    ordered = np.sort(key[same])
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if len(twice):
        at = np.searchsorted(twice, key).clip(max=len(twice) - 1)
        hit = np.flatnonzero((twice[at] == key) & same)
        for step in range(3):
            covered[hit + step] = True
    return covered


def line_table(texts: list[bytes]) -> Lines:
    """Line features and exact base counts of a slice of whole texts.

    n_words; word_chars: code points inside words; n_symbols: characters of
    ``#*$%&|<>``; n_dup_lines: lines with a word that equal an earlier line;
    n_repeat_words: words inside 3-word windows found twice or more.
    """
    n_docs = len(texts)
    buf = b"\n".join(texts)
    raw = np.frombuffer(buf, dtype=np.uint8)
    ends = np.append(np.flatnonzero(raw == 10), len(raw))
    starts = np.append(0, ends[:-1] + 1)
    line_texts = buf.split(b"\n")
    per_doc = np.array([t.count(b"\n") + 1 for t in texts], dtype=np.int64)
    doc_of_line = np.repeat(np.arange(n_docs), per_doc)
    first_line = np.append(0, np.cumsum(per_doc))

    flags = {k: t[raw] for k, t in _TABLES.items()}
    running = lambda m: np.append(0, np.cumsum(m, dtype=np.int64))
    count = lambda m: (lambda c: c[ends] - c[starts])(running(m))
    space = flags["space"]
    begins = ~space
    begins[1:] &= space[:-1]
    n_words = count(begins)
    chars = (ends - starts) - count(space) - count(flags["cont"])
    symbols, bars, bangs = count(flags["symbol"]), count(flags["bar"]), count(flags["bang"])
    upper, lower, digits = count(flags["upper"]), count(flags["lower"]), count(flags["digit"])
    # words that end in a symbol or an exclamation mark
    odd = flags["symbol"] | flags["bang"]
    closes = ~space
    closes[:-1] &= space[1:]
    symbol_words = count(closes & odd)

    words = buf.split()
    total = len(words)
    number = dict(zip(words, range(total)))
    ids = np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=total)
    line_of_word = np.repeat(np.arange(len(starts)), n_words)
    doc_of_word = doc_of_line[line_of_word]
    covered = repeated_windows(ids, doc_of_word, max(total, 1))
    again = np.zeros(total, dtype=bool)
    if total > 1:
        again[1:] = (ids[1:] == ids[:-1]) & (line_of_word[1:] == line_of_word[:-1])
    adjacent = np.bincount(line_of_word[again], minlength=len(starts))
    windowed = np.bincount(line_of_word[covered], minlength=len(starts))

    dup = np.zeros(len(starts), dtype=bool)
    filled = n_words > 0
    for d in range(n_docs):
        a, b = first_line[d], first_line[d + 1]
        if b - a > 1:
            own = line_texts[a:b]
            if len(set(own)) < b - a:
                first = dict(zip(reversed(own), range(b - a - 1, -1, -1)))
                dup[a:b] = [first[x] != k for k, x in enumerate(own)]
    dup &= filled

    t = Lines()
    t.texts, t.doc_of_line, t.first_line, t.filled = line_texts, doc_of_line, first_line, filled
    t.line_chars = chars
    by_doc = lambda v: np.add.reduceat(v, first_line[:-1]) if n_docs else v
    t.n_words, t.word_chars, t.n_symbols = by_doc(n_words), by_doc(chars), by_doc(symbols)
    t.n_dup_lines, t.n_repeat_words = by_doc(dup.astype(np.int64)), by_doc(windowed)
    w, c = np.maximum(n_words, 1), np.maximum(chars, 1)
    initial = np.zeros(len(starts), dtype=bool)
    has = ends > starts
    initial[has] = flags["lower"][raw_index(starts[has], len(raw))]
    t.features = np.stack([
        np.ones(len(starts)), symbol_words / w, np.minimum(symbols / c * 4, 2), np.minimum(bars / w * 2, 2),
        np.minimum(bangs / w, 2), upper / np.maximum(upper + lower, 1), digits / c, adjacent / w, windowed / w,
        n_words <= 2, (lower == 0) & filled, initial, ~filled, dup, np.minimum(chars / w / 10, 3)], axis=1)
    return t


def raw_index(at: np.ndarray, size: int) -> np.ndarray:
    return np.minimum(at, max(size - 1, 0))


def _padded(values: np.ndarray, lengths: np.ndarray, fill: float = 0.0) -> np.ndarray:
    """Rows of consecutive runs, padded to the longest: (runs, longest, ...)."""
    longest = int(lengths.max(initial=1))
    out = np.full((len(lengths), longest, *values.shape[1:]), fill, dtype=values.dtype)
    out[np.arange(longest)[None, :] < lengths[:, None]] = values
    return out


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def chain_marginals(emit: np.ndarray, lengths: np.ndarray, trans: np.ndarray):
    """Forward-backward over padded chains: log Z, node and summed edge marginals."""
    n, longest, k = emit.shape
    alive = np.arange(longest)[None, :] < lengths[:, None]
    fwd, bwd = np.zeros_like(emit), np.zeros_like(emit)
    fwd[:, 0] = emit[:, 0]
    for t in range(1, longest):
        step = _logsum(fwd[:, t - 1, :, None] + trans[None], 1) + emit[:, t]
        fwd[:, t] = np.where(alive[:, t, None], step, fwd[:, t - 1])
    for t in range(longest - 2, -1, -1):
        step = _logsum(trans[None] + (emit[:, t + 1] + bwd[:, t + 1])[:, None, :], 2)
        bwd[:, t] = np.where(alive[:, t + 1, None], step, 0.0)
    log_z = _logsum(fwd[:, -1], 1)
    nodes = np.exp(fwd + bwd - log_z[:, None, None]) * alive[:, :, None]
    edges = np.zeros((k, k))
    for t in range(1, longest):
        pair = fwd[:, t - 1, :, None] + trans[None] + (emit[:, t] + bwd[:, t])[:, None, :] - log_z[:, None, None]
        edges += (np.exp(pair) * alive[:, t, None, None]).sum(axis=0)
    return log_z, nodes, edges


def fit_crf(features: np.ndarray, labels: np.ndarray, lengths: np.ndarray, steps: int = 60,
            rate: float = 0.2, l2: float = 1e-3):
    """Maximum likelihood with unlabelled (-1) positions summed out; Adam in numpy."""
    dims = features.shape[1]
    emit_w, trans = np.zeros((2, dims)), np.zeros((2, 2))
    x = _padded(features, lengths)
    y = _padded(labels, lengths, -1)
    blocked = np.zeros((*y.shape, 2))
    blocked[y == CONTENT, BOILERPLATE] = -1e9
    blocked[y == BOILERPLATE, CONTENT] = -1e9
    total = max(int(lengths.sum()), 1)
    mean, var = [np.zeros_like(emit_w), np.zeros_like(trans)], [np.zeros_like(emit_w), np.zeros_like(trans)]
    for step in range(1, steps + 1):
        emit = x @ emit_w.T
        _, free, free_edges = chain_marginals(emit, lengths, trans)
        _, held, held_edges = chain_marginals(emit + blocked, lengths, trans)
        grads = [np.einsum("ntk,ntd->kd", held - free, x) / total - l2 * emit_w,
                 (held_edges - free_edges) / total - l2 * trans]
        for k, (w, g) in enumerate(zip((emit_w, trans), grads)):
            mean[k] = 0.9 * mean[k] + 0.1 * g
            var[k] = 0.99 * var[k] + 0.01 * g * g
            w += rate * (mean[k] / (1 - 0.9 ** step)) / (np.sqrt(var[k] / (1 - 0.99 ** step)) + 1e-8)
    return emit_w, trans


def viterbi(emit: np.ndarray, lengths: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Best label of every position; ``emit`` holds the chains one after another."""
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    sizes = lengths[order]
    longest = int(sizes.max(initial=0))
    back = np.zeros(emit.shape, dtype=np.int8)
    score = emit[starts].copy()
    last = np.zeros((len(sizes), emit.shape[1]))
    if longest == 1:
        last = score
    done = len(sizes)
    for t in range(1, longest):
        now = int(np.searchsorted(-sizes, -t, side="left"))  # chains longer than t
        last[now:done] = score[now:done]
        done = now
        at = starts[:now] + t
        via = score[:now, :, None] + trans[None]
        back[at] = via.argmax(axis=1)
        score = via.max(axis=1) + emit[at]
        if t == longest - 1:
            last[:now] = score
    labels = np.zeros(len(emit), dtype=np.int8)
    state = last.argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        now = int(np.searchsorted(-sizes, -t, side="left"))
        at = starts[:now] + t
        labels[at] = state[:now]
        if t:
            state[:now] = back[at, state[:now]]
    return labels


def fit(docs: DataFrame, labels: DataFrame, limit: int = FIT_ROWS):
    """(emission weights, transitions) from weak line labels of a bounded sample."""
    rows = training_rows(docs, ["text"], limit, labels, "quality", F.col("quality").isin(0, 1))
    for value in (0, 1):  # a label too rare for the sample gets rows of its own
        if not any(r["quality"] == value for r in rows):
            rows += training_rows(docs, ["text"], RARE_ROWS, labels, "quality", F.col("quality") == value)
    rows = [r for r in rows if r["text"]]
    quality = np.array([r["quality"] for r in rows], dtype=np.int64)
    if len(set(quality.tolist())) < 2:
        weights = np.zeros((2, len(FEATURES)))
        weights[CONTENT, 0] = 1.0
        return weights, np.zeros((2, 2))
    kinds: dict[bytes, int] = {}
    tables = []
    texts = [r["text"].encode() for r in rows]
    for i, j in byte_slices(texts):
        t = line_table(texts[i:j])
        tables.append((i, t))
        for line, d in zip(t.texts, t.doc_of_line):
            kinds[line] = kinds.get(line, 0) | (1 << int(quality[i + d]))
    features = np.concatenate([t.features for _, t in tables])
    y = np.concatenate([np.array([-1 if not f or kinds[x] == 3 else quality[i + d]
                                  for x, d, f in zip(t.texts, t.doc_of_line, t.filled)]) for i, t in tables])
    lengths = []
    for _, t in tables:
        for n in np.diff(t.first_line):
            lengths += [PIECE] * int(n // PIECE) + ([int(n % PIECE)] if n % PIECE else [])
    return fit_crf(features, y, np.array(lengths))


SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, content_share double")


def judge(texts: list[bytes], model) -> dict[str, np.ndarray]:
    """Columns of ``SCHEMA`` (without doc_id) for whole texts."""
    emit_w, trans = model
    parts = []
    for i, j in byte_slices(texts):
        t = line_table(texts[i:j])
        labels = viterbi(t.features @ emit_w.T, np.diff(t.first_line), trans)
        good = np.add.reduceat(np.where(labels == CONTENT, t.line_chars, 0), t.first_line[:-1])
        share = good / np.maximum(t.word_chars, 1)
        failed = (t.n_words < MIN_WORDS) | (100 * t.n_repeat_words > MAX_REPEAT_PERCENT * t.n_words)
        parts.append({"n_words": t.n_words, "word_chars": t.word_chars, "n_symbols": t.n_symbols,
                      "n_dup_lines": t.n_dup_lines, "n_repeat_words": t.n_repeat_words, "base_failed": failed,
                      "kept": ~failed & (share >= MIN_CONTENT), "content_share": share})
    return {k: np.concatenate([p[k] for p in parts]) for k in parts[0]} if parts else {}


def quality_table(docs: DataFrame, model) -> DataFrame:
    """One row per document with the counts, the verdict and the content share."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa
        for b in batches:
            if b.num_rows:
                cols = judge(text_bytes(b.column(1)), shared.value)
                yield pa.record_batch([b.column(0), *[pa.array(v) for v in cols.values()]],
                                      names=["doc_id", *cols])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def keep_good(docs: DataFrame, model) -> DataFrame:
    """Rows of ``docs`` whose text is kept; columns and order of columns unchanged."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    where = docs.columns.index("text")

    def run(batches):
        import pyarrow as pa
        for b in batches:
            if b.num_rows:
                yield b.filter(pa.array(judge(text_bytes(b.column(where)), shared.value)["kept"]))

    return docs.mapInArrow(run, docs.schema)
