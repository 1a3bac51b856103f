"""Language of texts by a linear-chain conditional random field over their words.

Each word is a position, each learnt language a label.  Emissions add hashed
features: the word itself (lexicon), the byte pairs, triples and quadruples
inside it with its borders as characters (so that n-grams at a border are
affixes).  Transitions are learnt with them.  Forward-backward gives every
word's label probabilities, also in code-switched text; a text's score for a
language is the mean over its words, and the best language is predicted.

Fit.  Whole texts of at most ``FIT_ROWS`` documents and ``LEAST_ROWS`` more of
each rarer language (chosen by a hash of doc_id, none over ``FIT_BYTES``, never
one whose crc32 mod 5 is 0) are cut into runs of words, and runs
of different documents are joined in chains, so that switches occur and the
transitions are learnt.  Only text and lang are used.

Inference cuts the chain of a text into blocks of ``BLOCK`` words.  The
blocks' transfer matrices are multiplied first, all blocks at once; a short
scan over the blocks of each text then gives the vectors that enter them.
The result is that of one pass over the whole chain.

Defined cases: null text, or one without a letter, is ``und`` with score 0;
so is everything if nothing can be learnt; fewer than ``CHAIN`` words to learn
from leave all weights at 0, so every text gets the first language, as on
equal scores; very long texts are predicted whole; extra columns are not read;
repeated rows each get a row.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentio.llm.common import byte_slices, held_out_expr, rows_by_label, ship_package, text_bytes, training_rows
from retentio.llm.quality_crf import chain_marginals
from retentio.llm.words import MULT, Words, bucket

FIT_ROWS = 500
LEAST_ROWS = 30  # of every language
UNKNOWN = "und"
BLOCK = 32
RUN = 12  # words of one document inside a training chain
CHAIN = 36
NGRAM_BITS = 16
WORD_BITS = 17
SIZE = 3 * (1 << NGRAM_BITS) + (1 << WORD_BITS) + 1
NONE = SIZE - 1  # stays at weight 0


def feature_ids(words: Words) -> tuple[list[np.ndarray], np.ndarray]:
    """Ids at each byte for n-grams ending there (three arrays), and one id a word."""
    raw, letter = words.raw, words.letter
    n = len(raw)
    wide = raw.astype(np.uint64)
    pair, triple, quad = (np.full(n, NONE, dtype=np.int64) for _ in range(3))
    two = (wide[:-1] << np.uint64(8)) | wide[1:]
    pair[1:] = two.astype(np.int64)
    three = (two[:-1] << np.uint64(8)) | wide[2:]
    ok = letter[1:-1]
    triple[2:][ok] = bucket((three[ok] + np.uint64(1)) * MULT, NGRAM_BITS) + (1 << NGRAM_BITS)
    four = (three[:-1] << np.uint64(8)) | wide[3:]
    ok = letter[2:-1] & letter[1:-2]
    quad[3:][ok] = bucket((four[ok] + np.uint64(7)) * MULT, NGRAM_BITS) + 2 * (1 << NGRAM_BITS)
    return [pair, triple, quad], bucket(words.hashes(), WORD_BITS) + 3 * (1 << NGRAM_BITS)


def emissions(words: Words, weights: np.ndarray) -> np.ndarray:
    """Scores (words, labels)."""
    if not len(words.start):
        return np.zeros((0, weights.shape[1]), dtype=np.float32)
    grams, lexicon = feature_ids(words)
    total = weights[grams[0]]
    total += weights[grams[1]]
    total += weights[grams[2]]
    bounds = np.stack([words.start, words.end + 1], axis=1).ravel()  # the border after a word counts
    if bounds[-1] >= len(total):
        bounds = bounds[:-1]
    return np.add.reduceat(total, bounds, axis=0)[::2] + weights[lexicon]


def posteriors(scores: np.ndarray, per_text: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Label probabilities of every word by forward-backward over blocks."""
    n, k = scores.shape
    out = np.zeros((n, k))
    if not n:
        return out
    emit = np.exp(scores.astype(np.float64) - scores.max(axis=1, keepdims=True))
    step = np.exp(trans - trans.max())
    used = np.flatnonzero(per_text)
    words = per_text[used]
    blocks = -(-words // BLOCK)
    first_block = np.cumsum(blocks) - blocks
    n_blocks = int(blocks.sum())
    text = np.repeat(np.arange(len(used)), blocks)
    place = np.arange(n_blocks) - first_block[text]
    begin = (np.cumsum(words) - words)[text] + place * BLOCK
    size = np.minimum(BLOCK, words[text] - place * BLOCK)
    opens = place == 0
    order = np.argsort(-size, kind="stable")
    longer = lambda t: int(np.searchsorted(-size[order], -t, side="left"))  # noqa: E731  blocks with over t words
    live = [order[:longer(t)] for t in range(int(size.max()))]

    norm = lambda m: m / m.sum(axis=-1, keepdims=True)
    # transfer matrices; the first word of a text has no transition before it
    moved = np.where(opens[:, None, None], np.eye(k)[None], step[None]) * emit[begin][:, None, :]
    for t in range(1, len(live)):
        b = live[t]
        m = (moved[b] @ step) * emit[begin[b] + t][:, None, :]
        moved[b] = m / m.sum(axis=(1, 2), keepdims=True)
    # vectors that enter and leave the blocks
    enter, leave = np.ones((n_blocks, k)), np.ones((n_blocks, k))
    by_size = np.argsort(-blocks, kind="stable")
    for s in range(1, int(blocks.max())):
        d = by_size[:int(np.searchsorted(-blocks[by_size], -s, side="left"))]
        b = first_block[d] + s
        enter[b] = norm(np.einsum("bi,bij->bj", enter[b - 1], moved[b - 1]))
        b = first_block[d] + blocks[d] - 1 - s
        leave[b] = norm(np.einsum("bij,bj->bi", moved[b + 1], leave[b + 1]))
    # inside the blocks
    forward = np.zeros((n, k))
    now = np.where(opens[:, None], enter, enter @ step) * emit[begin]
    forward[begin] = norm(now)
    for t in range(1, len(live)):
        at = begin[live[t]] + t
        forward[at] = norm((forward[at - 1] @ step) * emit[at])
    back = leave.copy()
    for t in range(len(live) - 1, -1, -1):
        b = live[t]
        at = begin[b] + t
        out[at] = norm(forward[at] * back[b])
        back[b] = norm((emit[at] * back[b]) @ step.T)
    return out


def fit_crf(texts: list[bytes], labels: np.ndarray, n_labels: int, epochs: int = 2, rate: float = 0.3,
            batch: int = 256, seed: int = 42):
    """(feature weights, transitions) by stochastic maximum likelihood over spliced chains."""
    rng = np.random.default_rng(seed)
    words = Words(texts)
    grams, lexicon = feature_ids(words)
    # ids of every word: its bytes' n-grams up to the border after it, then itself
    width = words.end + 1 - words.start
    n = len(width)
    ends = np.cumsum(width)
    at = np.repeat(words.start - (ends - width), width) + np.arange(int(ends[-1]) if n else 0)
    at = np.minimum(at, len(words.raw) - 1)
    label_of_word = np.repeat(labels, words.per_text)
    weights = np.zeros((SIZE, n_labels), dtype=np.float32)
    trans = np.zeros((n_labels, n_labels))
    power, power_t = np.full((SIZE, n_labels), 1e-2, dtype=np.float32), np.full((n_labels, n_labels), 1e-2)
    runs = np.arange(0, max(n - RUN + 1, 1), RUN)
    per_chain = CHAIN // RUN
    for _ in range(epochs):
        mixed = rng.permutation(runs)
        for a in range(0, len(mixed), batch * per_chain):
            some = mixed[a:a + batch * per_chain]
            some = some[:len(some) // per_chain * per_chain]
            if not len(some):
                continue
            w = (some[:, None] + np.arange(min(RUN, n))[None, :]).ravel()
            chains = len(some) // per_chain
            cells = np.repeat(np.arange(len(w)), width[w])
            local_ends = np.cumsum(width[w])
            byte = at[np.repeat((ends - width)[w] - (local_ends - width[w]), width[w]) + np.arange(len(cells))]
            ids = np.concatenate([*(g[byte] for g in grams), lexicon[w]])
            owner = np.concatenate([cells] * 3 + [np.arange(len(w))])
            score = np.zeros((len(w), n_labels))
            for k in range(n_labels):
                score[:, k] = np.bincount(owner, weights[ids, k], minlength=len(w))
            y = label_of_word[w].reshape(chains, -1)
            lengths = np.full(chains, y.shape[1])
            _, nodes, edges = chain_marginals(score.reshape(chains, -1, n_labels), lengths, trans)
            gap = -nodes.reshape(-1, n_labels)
            gap[np.arange(len(w)), y.ravel()] += 1
            seen = np.zeros_like(trans)
            np.add.at(seen, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
            for k in range(n_labels):
                g = np.bincount(ids, gap[owner, k], minlength=SIZE).astype(np.float32) / chains
                power[:, k] += g * g
                weights[:, k] += rate * g / np.sqrt(power[:, k])
            g = (seen - edges) / chains
            power_t += g * g
            trans += rate * g / np.sqrt(power_t)
            weights[NONE] = 0
    return weights, trans


def fit(docs: DataFrame, limit: int = FIT_ROWS, least: int = LEAST_ROWS):
    """(languages, weights, transitions) from a bounded sample outside the held-out part.

    The languages are those of all rows that may be learnt from; one that the
    sample of ``limit`` rows holds less than ``least`` times gets rows of its own.
    """
    usable = F.col("lang").isNotNull() & (F.col("text") != "") & ~held_out_expr()
    rows = training_rows(docs, ["text", "lang"], limit, condition=usable)
    seen = [r["lang"] for r in rows]
    rare = [r[0] for r in docs.where(usable).select("lang").distinct().collect() if seen.count(r[0]) < least]
    if rare:
        known = {r["doc_id"] for r in rows}
        rows += [r for r in rows_by_label(docs, ["text", "lang"], "lang", least, usable & F.col("lang").isin(rare))
                 if r["doc_id"] not in known]
    languages = sorted({r["lang"] for r in rows})
    if not languages:
        return [], np.zeros((SIZE, 0), dtype=np.float32), np.zeros((0, 0))
    labels = np.array([languages.index(r["lang"]) for r in rows])
    return (languages, *fit_crf([r["text"].encode() for r in rows], labels, len(languages)))


def has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


def predict(texts: list[bytes], model) -> tuple[list[str], np.ndarray]:
    """Language and score of whole texts."""
    languages, weights, trans = model
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if not languages:
        return names, scores
    for i, j in byte_slices(texts):
        words = Words(texts[i:j])
        used = np.flatnonzero(words.per_text)
        if not len(used):
            continue
        labels = posteriors(emissions(words, weights), words.per_text, trans)
        sizes = words.per_text[used]
        mean = np.add.reduceat(labels, np.cumsum(sizes) - sizes, axis=0) / sizes[:, None]
        best = mean.argmax(axis=1)
        for r, d in enumerate(used):
            t = texts[i + d]
            if t.isascii() or has_letter(t):
                names[i + d], scores[i + d] = languages[best[r]], min(1.0, mean[r, best[r]])
    return names, scores


def language_table(docs: DataFrame, model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa
        for b in batches:
            names, scores = predict(text_bytes(b.column(2)), shared.value)
            yield pa.record_batch([b.column(0), b.column(1), pa.array(names, pa.string()), pa.array(scores)],
                                  names=["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", held_out_expr().alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double")
