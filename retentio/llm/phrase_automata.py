"""Substring dedup with repeated-phrase automata.

A window is ``window`` consecutive words of one document.  A word goes if some
window over it also starts in a document with a smaller doc_id.

1. Copies.  Rows with the same words are one text; the smallest doc_id stands
   for it.  In the others every window recurs, so they lose all words.
2. Recurring phrases.  The anchor of a window is the smallest hash among its
   ``gram``-word phrases.  Equal windows have equal anchors, so only windows
   whose anchor occurs under two doc_ids can recur; texts without such an
   anchor are done.
3. Confirmation.  Windows under a recurring anchor meet by (anchor, window
   hash) in ascending doc_id, each with the first document that holds it.
   Candidate windows lie in pieces of at most ``PIECE`` windows; a link says
   that a piece of a smaller document holds a window of this one.  Anchors in
   more than ``hot`` documents are salted: each part finds its own first
   documents, and these meet by single windows.
4. Automata.  Each document gets the confirmed passages (the linked pieces'
   words).  The passages of a batch of documents are cut into shards; a shard
   compiles one Aho-Corasick automaton (pyahocorasick) of their half-window
   phrases over the shard's own word numbers.  Any window of a passage holds
   one such phrase whole.  The batch's documents are streamed through, every
   occurrence is extended word by word to the longest common run, and runs of
   at least ``window`` words are removed.  Only words decide here: a clash of
   hashes can add a candidate, never a removal.

Hashes are 64 bits of the anchor and 64 of the window, so a confirmation is
missed only where both clash.  No group of documents, windows or passages is
gathered in a task beyond ``hot`` rows of an anchor, a text and its passages.

Defined cases: null text counts as empty; rows without a doc_id neither lose
words nor take any from others; rows of one doc_id don't remove each other's
words; a text shorter than a window stays; extra columns are not read; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retentio.llm.common import byte_slices, ship_package, text_bytes
from retentio.session import written_table

WINDOW = 50
GRAM = 16
PIECE = 256  # windows a piece holds
HOT = 500  # documents of an anchor beyond which its windows are salted
SHARD_WORDS = 200_000  # words of the passages of one automaton
CHUNK = 1 << 22  # bytes whose words are hashed at once
EMPTY_SHA = hashlib.sha256(b"").hexdigest()

_BASE = 0x9E3779B97F4A7C15  # odd: its powers can be undone
_STEP = 0xD1342543DE82EF95
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_tables: dict = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    up, down = _tables.get(base, (np.ones(1, np.uint64), np.ones(1, np.uint64)))
    if len(up) < n:
        up, down = np.full((2, max(n, 2 * len(up))), 0, dtype=np.uint64)
        up[:], down[:] = base, pow(base, -1, 1 << 64)
        up[0] = down[0] = 1
        up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        _tables[base] = (up, down)
    return up[:n], down[:n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def word_codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit code of every word, number of words of each text)."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    space = _SPACE[raw]
    codes, starts, a = [], [], 0
    while a < len(raw):
        b = min(a + CHUNK, len(raw))
        while b < len(raw) and not space[b - 1]:  # end the chunk behind a word
            ahead = np.flatnonzero(space[b:b + CHUNK])
            b = b + int(ahead[0]) + 1 if len(ahead) else min(b + CHUNK, len(raw))
        part, edge = raw[a:b], np.flatnonzero(np.diff(space[a:b], prepend=True))
        start, end = edge[::2], edge[1::2]
        up, down = _powers(_BASE, len(part) + 1)
        total = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
        codes.append(_mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64)))
        starts.append(start + a)
        a = b
    stops = np.cumsum([len(t) + 1 for t in texts])
    return np.concatenate(codes), np.diff(np.searchsorted(np.concatenate(starts), stops), prepend=0)


def gram_codes(words: np.ndarray, size: int) -> np.ndarray:
    """Code of the ``size`` words from each word on."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    up, down = _powers(_STEP, len(words))
    total = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * up, out=total[1:])
    return _mix((total[size:] - total[:n]) * down[:n])


def sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    """Smallest of every ``size`` consecutive values."""
    reach = 1
    low = x
    while 2 * reach <= size:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    return low if reach == size else np.minimum(low[:len(x) - size + 1], low[size - reach:])


def windows_of(texts: list[bytes], window: int, gram: int):
    """(text, start word, anchor) of every window of the texts, and their words' codes."""
    words, counts = word_codes(texts)
    none = np.zeros(0, dtype=np.int64)
    if len(words) < window:
        return none, none, np.zeros(0, dtype=np.uint64), words, counts
    text = np.repeat(np.arange(len(texts)), counts)
    anchor = sliding_min(gram_codes(words, gram), window - gram + 1)
    inside = np.flatnonzero(text[:len(anchor)] == text[window - 1:])
    first = np.cumsum(counts) - counts
    return text[inside], inside - first[text[inside]], anchor[inside], words, counts


def _lists(values: np.ndarray, counts: np.ndarray):
    import pyarrow as pa
    ends = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def text_table(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, text_hash, n_words, words_sha256, anchors) of every row."""
    ship_package(docs.sparkSession)

    def run(batches):
        import pyarrow as pa
        for b in batches:
            texts = text_bytes(b.column(2))
            for i, j in byte_slices(texts):
                text, _, anchor, _, counts = windows_of(texts[i:j], window, gram)
                new = np.ones(len(text), dtype=bool)
                new[1:] = (text[1:] != text[:-1]) | (anchor[1:] != anchor[:-1])
                text, anchor = text[new], anchor[new]
                by = np.lexsort((anchor, text))
                text, anchor = text[by], anchor[by]
                new = np.ones(len(text), dtype=bool)
                new[1:] = (text[1:] != text[:-1]) | (anchor[1:] != anchor[:-1])
                text, anchor = text[new], anchor[new]
                yield pa.record_batch([
                    b.column(0).slice(i, j - i), b.column(1).slice(i, j - i), pa.array(counts, pa.int64()),
                    pa.array([hashlib.sha256(b" ".join(t.split())).digest() for t in texts[i:j]], pa.binary()),
                    _lists(anchor.view(np.int64), np.bincount(text, minlength=j - i))],
                    names=["doc_id", "text_hash", "n_words", "words_sha256", "anchors"])

    return keyed(docs).mapInArrow(
        run, "doc_id long, text_hash long, n_words long, words_sha256 binary, anchors array<long>")


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, text): doc_id and text hash name a text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                       text.alias("text"))


KEY = ["doc_id", "text_hash"]


def recurring_anchors(texts: DataFrame, hot: int) -> DataFrame:
    """(doc_id, text_hash, anchors, parts): the anchors of each text that occur under two doc_ids.

    ``parts`` is the number of salts of an anchor's windows.
    """
    flat = texts.select(*KEY, F.explode("anchors").alias("anchor"))
    seen = (flat.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"),
                                       F.count("*").alias("n"))
            .where("low < high").select("anchor", (1 + F.floor(F.col("n") / hot)).cast("int").alias("parts")))
    return (flat.join(seen, "anchor").groupBy(*KEY)
            .agg(F.sort_array(F.collect_list(F.struct("anchor", "parts"))).alias("a"))
            .select(*KEY, F.col("a.anchor").alias("anchors"), F.col("a.parts").alias("parts")))


def candidate_windows(text: bytes, anchors: np.ndarray, window: int, gram: int):
    """(start word, place in ``anchors``, piece, code) of the windows whose anchor recurs.

    A piece is a stretch of such windows in a row, at most ``PIECE`` of them,
    and is named by its first one; ``anchors`` are sorted.
    """
    _, start, anchor, words, _ = windows_of([text], window, gram)
    anchor = anchor.view(np.int64)
    at = np.minimum(np.searchsorted(anchors, anchor), len(anchors) - 1)
    found = np.flatnonzero(anchors[at] == anchor) if len(anchors) else np.zeros(0, dtype=np.int64)
    start, at = start[found], at[found]
    new = np.diff(start, prepend=-2) != 1
    begin = start[new][np.cumsum(new) - 1]
    return start, at, begin + (start - begin) // PIECE * PIECE, gram_codes(words, window)[start].view(np.int64)


def window_rows(live: DataFrame, window: int, gram: int) -> DataFrame:
    """(anchor, salt, parts, doc_id, text_hash, piece, codes): candidate windows by anchor and piece."""
    ship_package(live.sparkSession)

    def run(batches):
        import pyarrow as pa
        for b in batches:
            ids, hashes = (b.column(k).to_numpy() for k in (0, 1))
            texts = text_bytes(b.column(2))
            for r in range(b.num_rows):
                anchors = b.column(3)[r].values.to_numpy()
                parts = b.column(4)[r].values.to_numpy()
                _, at, piece, code = candidate_windows(texts[r], anchors, window, gram)
                by = np.lexsort((code, at, piece))
                at, piece, code = at[by], piece[by], code[by]
                group = np.ones(len(at), dtype=bool)
                group[1:] = (at[1:] != at[:-1]) | (piece[1:] != piece[:-1])
                keep = group.copy()
                keep[1:] |= code[1:] != code[:-1]
                sizes = np.add.reduceat(keep, np.flatnonzero(group)) if len(at) else np.zeros(0, np.int64)
                n = len(sizes)
                part = parts[at[group]]
                yield pa.record_batch([
                    pa.array(anchors[at[group]]), pa.array((hashes[r] % part).astype(np.int32)), pa.array(part),
                    pa.array(np.full(n, ids[r])), pa.array(np.full(n, hashes[r])), pa.array(piece[group]),
                    _lists(code[keep], sizes)], names=WINDOW_NAMES)

    return live.select(*KEY, "text", "anchors", "parts").mapInArrow(run, WINDOW_SCHEMA)


WINDOW_NAMES = ["anchor", "salt", "parts", "doc_id", "text_hash", "piece", "codes"]
WINDOW_SCHEMA = "anchor long, salt int, parts int, doc_id long, text_hash long, piece long, codes array<long>"
LINK_NAMES = ["doc_id", "text_hash", "from_id", "from_hash", "from_piece"]


def first_holders(windows: DataFrame) -> DataFrame:
    """Links of each (anchor, salt) group, and the first holders of the windows of salted anchors.

    A link row names the piece that holds a window of a greater doc_id's text;
    a holder row has ``codes`` instead.
    """
    spark = windows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        import pyarrow as pa
        group, first = None, {}
        salted = False

        def holders():
            by_holder: dict = {}
            for code, holder in first.items():
                by_holder.setdefault(holder, []).append(code)
            return [(*h, None, None, None, group[0], c) for h, c in by_holder.items()]

        def batch(rows):
            names = ["doc_id", "text_hash", "piece", "from_id", "from_hash", "from_piece", "anchor", "codes"]
            columns = list(zip(*rows))
            kinds = [pa.int64()] * 7 + [pa.list_(pa.int64())]
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for b in batches:
            rows = []
            for anchor, salt, n, doc, text, piece, codes in zip(*(b.column(k).to_pylist() for k in range(7))):
                if group != (anchor, salt):
                    if salted:
                        rows += holders()
                    group, first, salted = (anchor, salt), {}, n > 1
                own, found = (doc, text, piece), set()
                for c in codes:
                    holder = first.setdefault(c, own)
                    if holder[0] < doc:
                        found.add(holder)
                rows += [(doc, text, piece, *h, anchor, None) for h in found]
            if rows:
                yield batch(rows)
        if salted:
            rows = holders()
            if rows:
                yield batch(rows)

    # texts with the same doc_id stand side by side: only smaller ones count as holders
    grouped = windows.repartition(parts, "anchor", "salt").sortWithinPartitions("anchor", "salt", "doc_id",
                                                                               "text_hash", "piece")
    return grouped.mapInArrow(run, "doc_id long, text_hash long, piece long, from_id long, from_hash long, "
                                   "from_piece long, anchor long, codes array<long>")


def linked_pieces(live: DataFrame, window: int, gram: int) -> DataFrame:
    """Distinct (doc_id, text_hash, from_id, from_hash, from_piece)."""
    found = written_table(first_holders(window_rows(live, window, gram)))
    links = found.where("codes IS NULL").select(*LINK_NAMES)
    # first holders of the parts of a hot anchor: at most one row a part and window
    holders = found.where("codes IS NOT NULL").select("anchor", F.explode("codes").alias("code"), *KEY, "piece")
    by_window = Window.partitionBy("anchor", "code").orderBy("doc_id", "text_hash", "piece")
    head = F.first(F.struct(*KEY, "piece")).over(by_window)
    later = (holders.withColumn("head", head).where("head.doc_id < doc_id")
             .select(*KEY, F.col("head.doc_id").alias("from_id"), F.col("head.text_hash").alias("from_hash"),
                     F.col("head.piece").alias("from_piece")))
    return links.unionByName(later).distinct()


def piece_texts(live: DataFrame, window: int, gram: int) -> DataFrame:
    """(from_id, from_hash, from_piece, passage): the words of every candidate piece."""

    def run(batches):
        import pyarrow as pa
        for b in batches:
            texts = text_bytes(b.column(2))
            for r in range(b.num_rows):
                start, _, piece, _ = candidate_windows(texts[r], b.column(3)[r].values.to_numpy(), window, gram)
                words = texts[r].split()
                first = np.flatnonzero(np.diff(piece, prepend=-1))
                last = np.append(first[1:], len(piece)) - 1
                n = len(first)
                passages = [b" ".join(words[s:e + window]).decode() for s, e in zip(start[first], start[last])]
                yield pa.record_batch([b.column(0).take(pa.array([r] * n, pa.int64())),
                                       b.column(1).take(pa.array([r] * n, pa.int64())),
                                       pa.array(piece[first], pa.int64()), pa.array(passages, pa.string())],
                                      names=["from_id", "from_hash", "from_piece", "passage"])

    return live.select(*KEY, "text", "anchors").mapInArrow(
        run, "from_id long, from_hash long, from_piece long, passage string")


def as_codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)


class Shard:
    """One Aho-Corasick automaton of passages' half-window phrases, over its own word numbers."""

    def __init__(self, passages: list[tuple[int, list[bytes]]], window: int):
        import ahocorasick
        self.window, self.half = window, window // 2
        self.numbers: dict[bytes, int] = {}
        self.passages = []
        phrases: dict[str, list] = {}
        for doc_id, words in passages:
            text = self.number(words, True)
            self.passages.append((doc_id, as_codes(text)))
            n, k = len(self.passages) - 1, self.half
            for at in {*range(0, len(text) - k + 1, k), len(text) - k}:
                phrases.setdefault(text[at:at + k], []).append((n, at))
        self.automaton = ahocorasick.Automaton()
        for phrase, places in phrases.items():
            self.automaton.add_word(phrase, places)
        self.automaton.make_automaton()

    def number(self, words: list[bytes], add: bool = False) -> str:
        """One character a word; words of no passage share the first one."""
        numbers = self.numbers
        if add:
            for w in words:
                if w not in numbers:
                    n = len(numbers) + 1
                    numbers[w] = n if n < 0xD800 else n + 0x800  # no surrogates
        return "".join(map(chr, map(numbers.get, words, [0] * len(words))))

    def runs(self, words: list[bytes], doc_id: int):
        """(start, end) of the runs of ``words`` that passages of smaller doc_ids hold."""
        text = self.number(words)
        codes = as_codes(text)
        done: dict[tuple[int, int], int] = {}  # end of the last run on a passage's diagonal
        for last, places in self.automaton.iter(text):
            begin = last - self.half + 1
            for n, at in places:
                owner, passage = self.passages[n]
                if owner >= doc_id or done.get((n, begin - at), 0) > last:
                    continue
                right = min(len(codes) - begin, len(passage) - at)
                differ = np.flatnonzero(codes[begin:begin + right] != passage[at:at + right])
                end = begin + (int(differ[0]) if len(differ) else right)
                left = min(begin, at)
                differ = np.flatnonzero(codes[begin - left:begin] != passage[at - left:at])
                start = begin - left + (int(differ[-1]) + 1 if len(differ) else 0)
                done[(n, begin - at)] = end
                if end - start >= self.window:
                    yield start, end


def shards(passages, window: int, limit: int = SHARD_WORDS):
    """Automata of the distinct passages, each of at most about ``limit`` words."""
    held, size = [], 0
    for doc_id, passage in passages:
        words = passage.encode().split()
        held.append((doc_id, words))
        size += len(words)
        if size >= limit:
            yield Shard(held, window)
            held, size = [], 0
    if held:
        yield Shard(held, window)


def merged(runs) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(set(runs)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def removed_spans(batch: list[tuple[int, bytes, list]], window: int) -> list[list[tuple[int, int]]]:
    """Word ranges that each (doc_id, text, [(owner, passage)]) loses, found by the batch's automata."""
    words = [text.split() for _, text, _ in batch]
    own = [set(p) for _, _, p in batch]
    found: list[list] = [[] for _ in batch]
    # the smallest owner of a passage stands for all
    owners: dict[str, int] = {}
    for doc in own:
        for owner, passage in doc:
            owners[passage] = min(owner, owners.get(passage, owner))
    for shard in shards(((o, p) for p, o in owners.items()), window):
        for k, (doc_id, _, _) in enumerate(batch):
            found[k] += shard.runs(words[k], doc_id)
    return [merged(f) for f in found]


SPANS = "array<struct<start: long, end: long>>"


def streamed(matched: DataFrame, window: int) -> DataFrame:
    """(doc_id, text_hash, spans, n_removed, kept_sha256) of the texts that got passages."""
    ship_package(matched.sparkSession)

    def run(batches):
        import pyarrow as pa
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            texts = text_bytes(b.column(2))
            ids = b.column(0).to_pylist()
            for i, j in byte_slices(texts):
                some = [(ids[k], texts[k], [(p["owner"], p["passage"]) for p in b.column(3)[k].as_py()])
                        for k in range(i, j)]
                spans = removed_spans(some, window)
                shas, sizes = [], []
                for (_, text, _), cut in zip(some, spans):
                    words, kept, at = text.split(), [], 0
                    for s, e in cut:
                        kept += words[at:s]
                        at = e
                    kept += words[at:]
                    sizes.append(len(words) - len(kept))
                    shas.append(hashlib.sha256(b" ".join(kept)).hexdigest())
                yield pa.record_batch([
                    b.column(0).slice(i, j - i), b.column(1).slice(i, j - i),
                    pa.array([[{"start": s, "end": e} for s, e in cut] for cut in spans], kind),
                    pa.array(sizes, pa.int64()), pa.array(shas, pa.string())],
                    names=["doc_id", "text_hash", "spans", "n_removed", "kept_sha256"])

    return matched.select(*KEY, "text", "passages").mapInArrow(
        run, f"doc_id long, text_hash long, spans {SPANS}, n_removed long, kept_sha256 string")


def repeated_passages(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """(doc_id, text_hash, n_words, n_removed, kept_sha256, spans) of every row.

    ``spans`` are the removed ranges of words, ends exclusive; ``kept_sha256``
    is the digest of the kept words joined by single spaces.
    """
    if not 1 <= gram <= window // 2:
        raise ValueError("an anchor phrase must fit into half a window")
    texts = written_table(text_table(docs, window, gram))
    # one text for each sequence of words: that of the smallest doc_id
    first = written_table(texts.where("doc_id IS NOT NULL").groupBy("words_sha256")
                          .agg(F.min(F.struct(*KEY)).alias("first")))
    alone = texts.join(first.select("first.*"), KEY, "left_semi").dropDuplicates(KEY)
    recurring = written_table(recurring_anchors(alone, hot))
    live = written_table(keyed(docs).join(recurring, KEY).dropDuplicates(KEY))
    links = linked_pieces(live, window, gram)
    passages = (links.join(piece_texts(live, window, gram), ["from_id", "from_hash", "from_piece"])
                .groupBy(*KEY).agg(F.collect_list(F.struct(F.col("from_id").alias("owner"), "passage"))
                                   .alias("passages")))
    done = written_table(streamed(live.join(passages, KEY), window))
    of_first = done.select(F.struct(*KEY).alias("first"), "spans", "n_removed", "kept_sha256")
    rows = texts.join(first, "words_sha256", "left").join(of_first, "first", "left")
    copy = (F.col("doc_id") > F.col("first.doc_id")) & (F.col("n_words") >= window)
    same = F.col("doc_id") == F.col("first.doc_id")
    none = F.array().cast(SPANS)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end"))).cast(SPANS)
    return rows.select(
        *KEY, "n_words",
        F.when(copy, F.col("n_words")).when(same, F.coalesce("n_removed", F.lit(0))).otherwise(0)
        .cast("long").alias("n_removed"),
        F.when(copy, F.lit(EMPTY_SHA)).when(same & F.col("kept_sha256").isNotNull(), F.col("kept_sha256"))
        .otherwise(F.lower(F.hex("words_sha256"))).alias("kept_sha256"),
        F.when(copy, whole).when(same, F.coalesce("spans", none)).otherwise(none).alias("spans"))


def remove_passages(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """``docs`` with the kept words of each text, joined by single spaces; untouched texts stay as they are."""
    found = written_table(repeated_passages(docs, window, gram, hot))
    cut = (found.where("n_removed > 0").dropDuplicates(KEY)
           .select(F.col("doc_id").alias("_cut_id"), F.col("text_hash").alias("_cut_hash"), F.col("spans").alias("_cut")))
    words = F.regexp_extract_all(F.col("text"), F.lit(r"([^\x20\x09-\x0D]+)"))
    kept = F.filter(words, lambda w, i: ~F.exists("_cut", lambda s: (i >= s["start"]) & (i < s["end"])))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.join(cut, (F.col("doc_id").cast("long") == F.col("_cut_id"))
                     & (F.xxhash64(text) == F.col("_cut_hash")), "left")
    new = F.when(F.col("_cut").isNotNull(), F.array_join(kept, " ")).otherwise(F.col("text"))
    return rows.withColumn("text", new).select(*docs.columns)
