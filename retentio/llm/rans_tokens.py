"""Token ids to binary files with a static range asymmetric numeral system (rANS).

Documents are dealt out by ranges of doc_id and tokenised in that order with
a byte-level BPE file of the tokenizers library; id 0 ends every document.
Consecutive documents form segments of about ``SEGMENT_TOKENS`` ids.  One
segment is one row of the token files, and everything that decoding it needs
is in its payload:

    magic, ids in all, number of distinct ids, block length, lanes
    distinct ids (uint16 or uint32), quantised frequencies (uint32)
    for each block: ids, words, checkpoints, crc32 of the ids (uint32 each)
        checkpoint: step, place in the words, one 64-bit state a lane
        words (uint32)

The frequency table is shared by all blocks of the segment.  Blocks are
independent of each other.  Inside a block id i belongs to lane i % lanes, so
one numpy step codes all lanes; every ``CHECKPOINT_STEPS`` steps the decoder's
states are stored, so that it can start there.  The crc of each block is
checked when it is read.

Reading back, each document's first id is placed by prefix sums: a segment
says how many ids its range has before it, and one sum a range is gathered.

:func:`token_spans` decodes in parallel: each stretch from one checkpoint to the
next is a row of its own, with its slice of the payload, and goes to any task.

Defined cases: null or empty text is the end id alone; a null doc_id sorts
first; rows of one doc_id stand in the order of their texts' hashes, so that a
retry gives the same files; repeated rows are all written; extra columns are
not read; a long text is written whole, so its segment may exceed
``SEGMENT_TOKENS``; a segment can hold 2**18 distinct ids (more raise
``ValueError``); an empty table gives an empty result.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentio.llm.common import ship_package, text_bytes
from retentio.llm.word_table import BREAK, FIRST, SPACE, WordTable
from retentio.session import written_table

END_ID = 0
SEGMENT_TOKENS = 4_000_000
BLOCK_TOKENS = 1 << 20
LANES = 2048
CHECKPOINT_STEPS = 256
SCALE = 18  # bits of the frequency table's total
LOW = np.uint64(1 << 31)  # smallest state between steps
JOINED = 500  # words encoded in one call
MAGIC = b"RTK1"
_BLANK = b"\t\r\x0b\x0c\x1c\x1d\x1e\x1f"  # white space beside space and line break
_HEAD = struct.Struct("<4sQIII")
_BLOCK = struct.Struct("<IIII")


def quantise(counts: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Frequencies of at least 1 that add up to 2**scale."""
    total = 1 << scale
    if len(counts) > total:
        raise ValueError("more distinct ids than the table can hold")
    freq = np.maximum(1, counts.astype(np.float64) / counts.sum() * total).astype(np.int64)
    left = total - int(freq.sum())
    order = np.argsort(-freq, kind="stable")
    if left > 0:
        freq[order[0]] += left
    for k in order:
        if left >= 0:
            break
        take = min(int(freq[k]) - 1, -left)
        freq[k] -= take
        left += take
    return freq


def encode_block(symbols: np.ndarray, freq: np.ndarray, cum: np.ndarray, lanes: int = LANES) -> bytes:
    """Checkpoints and words of one block (``symbols`` index the frequency table)."""
    n = len(symbols)
    steps = -(-n // lanes)
    state = np.full(lanes, LOW, dtype=np.uint64)
    f_all, c_all = freq[symbols].astype(np.uint64), cum[symbols].astype(np.uint64)
    limit = np.uint64(((1 << 31) >> SCALE) << 32)
    shift, low = np.uint64(SCALE), np.uint64(0xFFFFFFFF)
    written: list[np.ndarray] = []
    marks = []  # (step, states), from the last step back
    for t in range(steps - 1, -1, -1):
        f, c = f_all[t * lanes:(t + 1) * lanes], c_all[t * lanes:(t + 1) * lanes]
        x = state[:len(f)]
        over = x >= f * limit
        written.append((x[over] & low).astype(np.uint32))
        x = np.where(over, x >> np.uint64(32), x)
        q = x // f
        state[:len(f)] = (q << shift) + (x - q * f) + c
        if t % CHECKPOINT_STEPS == 0:
            marks.append((t, state.copy()))
    written.reverse()
    before = np.cumsum([0] + [len(w) for w in written])
    words = np.concatenate(written) if written else np.zeros(0, dtype=np.uint32)
    out = [_BLOCK.pack(n, len(words), len(marks), 0)]
    for t, s in reversed(marks):
        out.append(struct.pack("<II", t, int(before[t])) + s.tobytes())
    return b"".join(out) + words.tobytes()


def decode_steps(state: np.ndarray, words: np.ndarray, place: int, first: int, last: int, n: int,
                 table: np.ndarray, freq: np.ndarray, cum: np.ndarray, out: np.ndarray) -> None:
    """Decodes steps first..last-1 of a block of n ids into ``out`` from a checkpoint's state."""
    lanes = len(state)
    state = state.copy()
    mask, shift = np.uint64((1 << SCALE) - 1), np.uint64(SCALE)
    for t in range(first, last):
        k = min(lanes, n - t * lanes)
        x = state[:k]
        slot = x & mask
        s = table[slot]
        out[t * lanes:t * lanes + k] = s
        x = freq[s] * (x >> shift) + slot - cum[s]
        need = np.flatnonzero(x < LOW)
        if len(need):
            x[need] = (x[need] << np.uint64(32)) | words[place:place + len(need)]
            place += len(need)
        state[:k] = x


def encode_segment(ids: np.ndarray, block: int = BLOCK_TOKENS, lanes: int = LANES) -> bytes:
    """Payload of a segment of unsigned ids."""
    if len(ids) and int(ids.max()) < 1 << 20:
        counts = np.bincount(ids)
        symbols = np.flatnonzero(counts)
        number = np.zeros(len(counts), dtype=np.int64)
        number[symbols] = np.arange(len(symbols))
        index, counts = number[ids], counts[symbols]
    else:
        symbols, index, counts = np.unique(ids, return_inverse=True, return_counts=True)
    wide = np.uint16 if not len(symbols) or symbols[-1] < 1 << 16 else np.uint32
    freq = quantise(counts) if len(ids) else np.zeros(0, dtype=np.int64)
    cum = np.cumsum(freq) - freq
    lanes = max(1, min(lanes, -(-len(ids) // 64)))
    out = [_HEAD.pack(MAGIC, len(ids), len(symbols), block, lanes | (wide().itemsize << 24)),
           symbols.astype(wide).tobytes(), freq.astype(np.uint32).tobytes()]
    for i in range(0, len(ids), block):
        body = encode_block(index[i:i + block], freq, cum, lanes)
        crc = zlib.crc32(ids[i:i + block].astype("<u4").tobytes())
        out.append(body[:12] + struct.pack("<I", crc) + body[16:])
    return b"".join(out)


def decode_segment(payload: bytes) -> np.ndarray:
    """Ids (uint32) of a payload; raises ValueError if a block fails its checksum."""
    magic, total, distinct, block, packed = _HEAD.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("not a token segment")
    lanes, width = packed & 0xFFFFFF, packed >> 24
    at = _HEAD.size
    symbols = np.frombuffer(payload, dtype=f"<u{width}", count=distinct, offset=at).astype(np.uint32)
    at += distinct * width
    freq = np.frombuffer(payload, dtype="<u4", count=distinct, offset=at).astype(np.uint64)
    at += distinct * 4
    cum = np.cumsum(freq) - freq
    table = np.repeat(np.arange(distinct, dtype=np.uint32), freq.astype(np.int64))
    out = np.empty(total, dtype=np.uint32)
    done = 0
    while done < total:
        n, n_words, n_marks, crc = _BLOCK.unpack_from(payload, at)
        at += _BLOCK.size
        marks = []
        for _ in range(n_marks):
            step, place = struct.unpack_from("<II", payload, at)
            marks.append((step, place, np.frombuffer(payload, dtype=np.uint64, count=lanes, offset=at + 8)))
            at += 8 + 8 * lanes
        words = np.frombuffer(payload, dtype="<u4", count=n_words, offset=at).astype(np.uint64)
        at += 4 * n_words
        found = np.empty(n, dtype=np.uint32)
        steps = -(-n // lanes)
        for k, (step, place, state) in enumerate(marks):
            last = marks[k + 1][0] if k + 1 < len(marks) else steps
            decode_steps(state, words, place, step, last, n, table, freq, cum, found)
        ids = symbols[found]
        if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
            raise ValueError("checksum of a token block differs")
        out[done:done + n] = ids
        done += n
    return out


def span_directory(payload: bytes) -> tuple[int, int, list[tuple[int, int, int, int, int]]]:
    """(bytes of the head, bytes of a state, spans as (first id, ids, state offset, words offset, words)).

    A span runs from one checkpoint to the next or to the end of its block.
    """
    magic, total, distinct, _, packed = _HEAD.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("not a token segment")
    lanes, width = packed & 0xFFFFFF, packed >> 24
    at = _HEAD.size + distinct * (width + 4)
    spans, done = [], 0
    while done < total:
        n, n_words, n_marks, _ = _BLOCK.unpack_from(payload, at)
        at += _BLOCK.size
        words = at + n_marks * (8 + 8 * lanes)
        marks = [(*struct.unpack_from("<II", payload, at + k * (8 + 8 * lanes)), at + k * (8 + 8 * lanes) + 8)
                 for k in range(n_marks)]
        for k, (step, place, state) in enumerate(marks):
            ends = (marks[k + 1][0] * lanes, marks[k + 1][1]) if k + 1 < n_marks else (n, n_words)
            spans.append((done + step * lanes, ends[0] - step * lanes, state, words + 4 * place, ends[1] - place))
        at = words + 4 * n_words
        done += n
    return _HEAD.size + distinct * (width + 4), 8 * lanes, spans


def decode_span(head: bytes, state: bytes, words: bytes, n: int) -> np.ndarray:
    """The ``n`` ids of one span from the segment's head (with its table), a checkpoint and its words."""
    _, _, distinct, _, packed = _HEAD.unpack_from(head)
    width = packed >> 24
    symbols = np.frombuffer(head, dtype=f"<u{width}", count=distinct, offset=_HEAD.size).astype(np.uint32)
    freq = np.frombuffer(head, dtype="<u4", count=distinct, offset=_HEAD.size + distinct * width).astype(np.uint64)
    table = np.repeat(np.arange(distinct, dtype=np.uint32), freq.astype(np.int64))
    states = np.frombuffer(state, dtype=np.uint64)
    found = np.empty(n, dtype=np.uint32)
    decode_steps(states, np.frombuffer(words, dtype="<u4").astype(np.uint64), 0, 0, -(-n // len(states)), n,
                 table, freq, np.cumsum(freq) - freq, found)
    return symbols[found]


def token_spans(segments: DataFrame) -> DataFrame:
    """(part, seg, first, ids): every stretch between checkpoints, decoded as a row of its own.

    The payloads are cut in the JVM, so that a span's task gets the segment's
    table, one checkpoint and the span's words, not the segment.
    """
    spark = segments.sparkSession
    ship_package(spark)
    fields = ("first", "n", "state_at", "words_at", "n_words")

    def directory(batches):
        import pyarrow as pa
        kind = pa.list_(pa.struct([(f, pa.int64()) for f in fields]))
        for b in batches:
            for r in range(b.num_rows):
                payload = b.column(2)[r].as_py()
                head, state, found = span_directory(payload)
                spans = [dict(zip(fields, s)) for s in found]
                yield pa.record_batch([
                    b.column(0).slice(r, 1), b.column(1).slice(r, 1), b.column(2).slice(r, 1),
                    pa.array([head]), pa.array([state]), pa.array([spans], kind)],
                    names=["part", "seg", "payload", "head", "state", "spans"])

    def run(batches):
        import pyarrow as pa
        for b in batches:
            for r in range(b.num_rows):
                head, state, words, n = (b.column(k)[r].as_py() for k in range(3, 7))
                ids = decode_span(head, state, words, n)
                yield pa.record_batch([b.column(0).slice(r, 1), b.column(1).slice(r, 1), b.column(2).slice(r, 1),
                                       pa.array([ids.astype(np.int64)], pa.list_(pa.int64()))],
                                      names=["part", "seg", "first", "ids"])

    struct_type = ", ".join(f"{f}: long" for f in fields)
    rows = segments.select("part", "seg", "payload").mapInArrow(
        directory, f"part int, seg int, payload binary, head long, state long, spans array<struct<{struct_type}>>")
    cut = lambda at, size: F.expr(f"substring(payload, cast({at} + 1 as int), cast({size} as int))")
    spans = rows.select("*", F.explode("spans").alias("s")).select(
        "part", "seg", F.col("s.first").alias("first"), cut("0", "head").alias("head"),
        cut("s.state_at", "state").alias("state"), cut("s.words_at", "4 * s.n_words").alias("words"),
        F.col("s.n").alias("n"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return spans.repartition(parts, "part", "seg", "first").mapInArrow(
        run, "part int, seg int, first long, ids array<long>")


def cuts_at_words(path: str) -> bool:
    """Whether the file's tokens never join a word with what follows its space: plain byte-level rules."""
    import json
    with open(path, encoding="utf-8") as f:
        own = json.load(f)
    pre = own.get("pre_tokenizer") or {}
    spaced = any(" " in t["content"] or t.get("lstrip") or t.get("rstrip") for t in own.get("added_tokens", []))
    return (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
            and own.get("normalizer") is None and not spaced)


class BpeEncoder:
    """Word-cached encoding with a tokenizers file; equal to encoding whole texts."""

    def __init__(self, path: str, limit: int = 2_000_000):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        n = self.tokenizer.get_vocab_size()
        # byte-level tokens are written with one character a byte
        self.width = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(n)], dtype=np.int64)
        self.table = WordTable(self.words, self.whole, self.usable, np.uint16 if n <= 1 << 16 else np.uint32,
                               limit) if cuts_at_words(path) else None

    def whole(self, text: str | bytes) -> list[int]:
        text = text if isinstance(text, str) else text.decode()
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    @staticmethod
    def usable(word: bytes) -> bool:
        """A cut needs a visible character on both sides of its space or line break."""
        if word.isascii():
            return word.strip(_BLANK) == word
        w = word.decode()
        return w.strip() == w

    def words(self, words: list[bytes], kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words with a space or line break in front are encoded joined: their tokens can't
        cross, and the tokens' byte lengths tell where each word ends.  First words come last."""
        sizes = np.zeros(len(words), dtype=np.int64)
        before = {FIRST: b"", SPACE: b" ", BREAK: b"\n"}
        texts = [before[k] + w for w, k in zip(words, kinds.tolist())]
        stop = int(np.searchsorted(kinds == FIRST, True))
        parts: list[np.ndarray] = []
        for a in range(0, len(words), JOINED):
            some = texts[a:a + JOINED]
            fits = False
            if a + len(some) <= stop:
                ids = np.array(self.whole(b"".join(some)), dtype=np.uint32)
                ends = np.cumsum(self.width[ids])
                want = np.cumsum([len(t) for t in some])
                cut = np.searchsorted(ends, want)
                fits = len(ids) > 0 and ends[-1] == want[-1] and bool((ends[cut] == want).all())
            if fits:
                sizes[a:a + len(some)] = np.diff(cut, prepend=-1)
            else:
                own = [e.ids for e in self.tokenizer.encode_batch_fast([t.decode() for t in some],
                                                                       add_special_tokens=False)]
                sizes[a:a + len(own)] = [len(o) for o in own]
                ids = np.array([i for o in own for i in o], dtype=np.uint32)
            parts.append(ids)
        return np.concatenate(parts), sizes

    def encode(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each) of strings or their UTF-8 bytes."""
        texts = [t.encode() if isinstance(t, str) else t for t in texts]
        if self.table is not None:
            return self.table.encode(texts)
        own = [np.array(self.whole(t), dtype=np.uint32) for t in texts]
        return np.concatenate(own), np.array([len(o) for o in own], dtype=np.int64)


_ENCODERS: dict[str, BpeEncoder] = {}


def encoder(path: str) -> BpeEncoder:
    """One encoder a worker process, so that its word cache outlives a task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = BpeEncoder(path)
    return _ENCODERS[path]


SEGMENT_SCHEMA = ("part int, seg int, inside long, n_tokens long, doc_ids array<long>, doc_tokens array<int>, "
                  "payload binary")


def token_segments(docs: DataFrame, tokenizer: str, segment: int = SEGMENT_TOKENS) -> DataFrame:
    """Rows of the token files; ``tokenizer`` is a path every executor has."""
    spark = docs.sparkSession
    ship_package(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        part, seg, inside = TaskContext.get().partitionId(), 0, 0
        coder = encoder(tokenizer)
        held_ids, held_docs, held_sizes, held = [], [], [], 0

        def flush():
            ids = np.concatenate(held_ids)
            return pa.record_batch([
                pa.array([part], pa.int32()), pa.array([seg], pa.int32()), pa.array([inside], pa.int64()),
                pa.array([len(ids)], pa.int64()),
                pa.array([held_docs], pa.list_(pa.int64())), pa.array([held_sizes], pa.list_(pa.int32())),
                pa.array([encode_segment(ids)], pa.binary())],
                names=["part", "seg", "inside", "n_tokens", "doc_ids", "doc_tokens", "payload"])

        for b in batches:
            doc_ids = b.column(0).to_pylist()
            texts = text_bytes(b.column(1))
            i = 0
            while i < len(texts):
                j, size = i, 0
                while j < len(texts) and (j == i or size + len(texts[j]) <= 1 << 22):
                    size += len(texts[j])
                    j += 1
                ids, sizes = coder.encode(texts[i:j])
                # the end id after every document
                with_end = np.full(len(ids) + j - i, END_ID, dtype=np.uint32)
                place = np.arange(len(ids)) + np.repeat(np.arange(j - i), sizes)
                with_end[place] = ids
                held_ids.append(with_end)
                held_docs += doc_ids[i:j]
                held_sizes += (sizes + 1).tolist()
                held += len(with_end)
                if held >= segment:
                    yield flush()
                    seg, inside = seg + 1, inside + held
                    held_ids, held_docs, held_sizes, held = [], [], [], 0
                i = j
        if held_docs:
            yield flush()

    # rows of one doc_id, however many, stand in the order of their texts
    keys = ["doc_id", "text_hash", "text"]
    ordered = (docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
               .repartitionByRange(parts, *keys[:2]).sortWithinPartitions(*keys))
    return ordered.select("doc_id", "text").mapInArrow(run, SEGMENT_SCHEMA)


def write_tokens(docs: DataFrame, tokenizer: str, path: str | None = None) -> DataFrame:
    """Writes the token files (under the shared folder if no path is given) and reads them back."""
    rows = token_segments(docs, tokenizer)
    if path is None:
        return written_table(rows)
    rows.write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def document_tokens(segments: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the payloads."""
    spark = segments.sparkSession
    ship_package(spark)
    sums = {r[0]: r[1] for r in segments.groupBy("part").agg(F.sum("n_tokens")).collect()}  # a row a range
    before, total = {}, 0
    for part in sorted(sums):
        before[part] = total
        total += sums[part]
    placed = segments.select("part", "inside", "doc_ids", "doc_tokens", "payload")

    def run(batches):
        import pyarrow as pa
        for b in batches:
            for r in range(b.num_rows):
                part, inside, doc_ids, sizes = (b.column(k)[r].as_py() for k in range(4))
                ids = decode_segment(b.column(4)[r].as_py()).astype("<u4")
                sizes = np.array(sizes, dtype=np.int64)
                ends = np.cumsum(sizes)
                crcs = [zlib.crc32(ids[e - n:e]) for n, e in zip(sizes, ends)]
                yield pa.record_batch([
                    pa.array(doc_ids, pa.int64()), pa.array(before[part] + inside + ends - sizes),
                    pa.array(sizes), pa.array(crcs, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
