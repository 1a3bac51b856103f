"""SimHash near-duplicates with pigeonring filtering.

Fingerprint: 64 bits over the 3-word shingles of the lower-cased text (XXH64,
seed 42); a bit is one if set in over half of the shingle hashes.  Texts link
at ``MAX_BITS`` or fewer differing bits; classes are the connected components.

Candidates.  The fingerprint is a ring of four 16-bit segments.  If two
fingerprints differ in at most 3 bits, some segment starts a chain whose
cumulative differences stay within the proportional budget l * 3/4 for every
chain length l, that is 0, 1, 2, 3 bits.  The first two steps are an index:
the start segment is equal, and the next one differs in at most one bit, so
one of its halves is equal.  Each distinct fingerprint therefore enters eight
buckets of 24 bits.  The longer chains prune inside the bucket before the
full Hamming check.  Buckets are cut into blocks and compared block by block;
a block returns a spanning star of its links, never all pairs.

Defined cases: null or empty text has fingerprint zero and links like any
other; repeated rows each get a row; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentio.llm.common import (byte_slices, connected_components, link_components, ship_package,
                                 text_bytes)
from retentio.session import written_table

SHINGLE_WORDS = 3
MAX_BITS = 3
SEGMENTS = 4
BLOCK = 512  # fingerprints a side of one block comparison

# SPREAD[b]: eight bytes holding the bits of b, most significant first, so that
# one 64-bit addition counts eight bit positions at once.
SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).copy().view(np.uint64)[:, 0]


def shingle_digests(text: bytes, width: int = SHINGLE_WORDS) -> list[bytes]:
    """XXH64 digests (big-endian) of the word shingles, repeats included."""
    import xxhash
    words = text.lower().split()
    if not words:
        return []
    if len(words) < width:
        return [xxhash.xxh64_digest(b" ".join(words), 42)]
    digest, join = xxhash.xxh64_digest, b" ".join
    return [digest(join(s), 42) for s in zip(*(words[i:] for i in range(width)))]


def fingerprints(texts: list[bytes], width: int = SHINGLE_WORDS) -> np.ndarray:
    """Signed 64-bit fingerprints of the texts."""
    out = np.zeros(len(texts), dtype=np.int64)
    for i, j in byte_slices(texts):
        parts = [shingle_digests(t, width) for t in texts[i:j]]
        sizes = np.array([len(p) for p in parts], dtype=np.int64)
        full = np.flatnonzero(sizes)
        if not len(full):
            continue
        raw = np.frombuffer(b"".join([b"".join(p) for p in parts]), dtype=np.uint8).reshape(-1, 8)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        # cut every text into runs of at most 255 shingles: byte counters can't overflow
        cuts = np.concatenate([np.arange(starts[k], ends[k], 255) for k in full])
        counts8 = np.add.reduceat(SPREAD[raw], cuts, axis=0)
        counts = counts8.view(np.uint8).reshape(len(cuts), 64).astype(np.int64)
        first = np.searchsorted(cuts, starts[full])
        counts = np.add.reduceat(counts, first, axis=0)
        bits = counts * 2 > sizes[full][:, None]
        out[i + full] = np.packbits(bits, axis=1).view(">i8")[:, 0]
    return out


def fingerprint_table(docs: DataFrame, width: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp) with one row for each input row."""
    ship_package(docs.sparkSession)

    def run(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array(fingerprints(text_bytes(b.column(1)), width))],
                                  names=["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


def bucket_keys(fp: str = "fp") -> list:
    """Eight keys: (start segment, half) number, start segment, half of the next one."""
    seg = [F.shiftrightunsigned(F.col(fp), 48 - 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in range(SEGMENTS)]
    keys = []
    for i in range(SEGMENTS):
        nxt = seg[(i + 1) % SEGMENTS]
        for half in range(2):
            part = F.shiftrightunsigned(nxt, 8 * (1 - half)).bitwiseAND(F.lit(0xFF))
            keys.append(F.lit((2 * i + half) << 24).cast("long") + seg[i] * 256 + part)
    return keys


def ring_links(left: np.ndarray, right: np.ndarray, start: int, max_bits: int = MAX_BITS) -> np.ndarray:
    """Boolean matrix of links whose chain from ``start`` stays within its budgets."""
    x = left[:, None] ^ right[None, :]
    total = np.zeros(x.shape, dtype=np.uint8)
    ok = np.ones(x.shape, dtype=bool)
    for step in range(SEGMENTS):
        shift = np.uint64(48 - 16 * ((start + step) % SEGMENTS))
        total += np.bitwise_count((x >> shift) & np.uint64(0xFFFF))
        ok &= total <= (step + 1) * max_bits // SEGMENTS
        if not ok.any():
            break
    return ok


def _bucket_edges(batches):
    """Spanning stars of the links inside each (key, bi, bj) run of sorted rows."""
    import pyarrow as pa

    def emit(key, bi, bj, fp, blk):
        u = fp.view(np.uint64)
        start = int(key >> 24) // 2
        n = len(fp)
        linked = np.zeros((n, n), dtype=bool)
        if bi == bj:
            linked = ring_links(u, u, start)
        else:
            i, j = np.flatnonzero(blk == bi), np.flatnonzero(blk != bi)
            if len(i) and len(j):
                m = ring_links(u[i], u[j], start)
                linked[np.ix_(i, j)] = m
                linked[np.ix_(j, i)] = m.T
        root = link_components(linked)
        moved = np.flatnonzero(root != np.arange(n))
        return fp[moved], fp[root[moved]]

    held = None
    for b in batches:
        cols = [b.column(k).to_numpy(zero_copy_only=False) for k in range(5)]
        if held is not None:
            cols = [np.concatenate([h, c]) for h, c in zip(held, cols)]
        key, bi, bj, fp, blk = cols
        if not len(key):
            continue
        change = np.flatnonzero((key[1:] != key[:-1]) | (bi[1:] != bi[:-1]) | (bj[1:] != bj[:-1])) + 1
        bounds = np.concatenate([[0], change])
        out = [emit(key[s], bi[s], bj[s], fp[s:e], blk[s:e]) for s, e in zip(bounds[:-1], bounds[1:]) if e - s > 1]
        held = [c[bounds[-1]:] for c in cols]
        if out:
            yield pa.record_batch([pa.array(np.concatenate([o[k] for o in out])) for k in (0, 1)], names=["a", "b"])
    if held is not None and len(held[0]) > 1:
        a, c = emit(held[0][0], held[1][0], held[2][0], held[3], held[4])
        yield pa.record_batch([pa.array(a), pa.array(c)], names=["a", "b"])


def fingerprint_edges(distinct: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that span every class of links."""
    spark = distinct.sparkSession
    ship_package(spark)
    keyed = distinct.select("fp", F.explode(F.array(*bucket_keys())).alias("key"))
    sizes = written_table(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    blocks = F.ceil(F.col("n") / BLOCK)
    rows = (keyed.join(sizes, "key")
            .select("key", "fp", blocks.alias("nb"), F.pmod(F.xxhash64("fp"), blocks).alias("blk"))
            .select("key", "fp", "blk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)).alias("other"))
            .select("key", F.least("blk", "other").alias("bi"), F.greatest("blk", "other").alias("bj"), "fp", "blk"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, "key", "bi", "bj").sortWithinPartitions("key", "bi", "bj", "fp")
    return rows.mapInArrow(_bucket_edges, "a long, b long")


def fingerprint_roots(fps: DataFrame) -> DataFrame:
    """(fp, root) of every distinct fingerprint; ``root`` is the same for all of a class."""
    distinct = written_table(fps.select("fp").distinct())
    roots = connected_components(fingerprint_edges(distinct)).withColumnRenamed("node", "fp")
    return written_table(distinct.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id): one row per input row, smallest doc_id of its class."""
    fps = written_table(fingerprint_table(docs))
    classes = fingerprint_roots(fps)
    reps = fps.groupBy("fp").agg(F.min("doc_id").alias("rep")).join(classes, "fp")
    smallest = reps.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = written_table(classes.join(smallest, "root").select("fp", "component_id"))
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def deduplicate(docs: DataFrame) -> DataFrame:
    """One row of each class: that with the smallest (doc_id, fingerprint, hash of the text, hash of the row).

    A class is told by its fingerprints, not by doc_ids, so that two unlinked
    texts under one doc_id both stay.  Of rows with the same doc_id and text
    the one with the smallest hash of its columns stays.  Rows without a
    doc_id can't be compared by id and stay.  All columns are kept.

    The kept row is chosen on hashes alone; whole rows are joined with the
    choice (a join that may shuffle and sort them).  Those that occur once are
    not aggregated; those that occur again are folded to one.
    """
    ship_package(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    plain = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    with_id = docs.where(F.col("doc_id").isNotNull())

    def run(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.record_batch([*b.columns[:3], pa.array(fingerprints(text_bytes(b.column(3))))],
                                  names=["doc_id", "text_hash", "row_hash", "fp"])

    keyed = with_id.select("doc_id", F.xxhash64(text).alias("text_hash"), F.xxhash64(*plain).alias("row_hash"),
                           text.alias("text"))
    fps = written_table(keyed.mapInArrow(run, "doc_id long, text_hash long, row_hash long, fp long"))
    rows = fps.groupBy("doc_id", "fp", "text_hash", "row_hash").agg(F.count("*").alias("n"))
    first = written_table(rows.join(fingerprint_roots(fps), "fp").groupBy("root")
                          .agg(F.min(F.struct("doc_id", "fp", "text_hash", "row_hash", "n")).alias("first"))
                          .select(*[F.col(f"first.{c}").alias(f"_kept_{c}") for c in ("doc_id", "text_hash", "row_hash", "n")]))
    same = ((F.col("doc_id") == F.col("_kept_doc_id")) & (F.xxhash64(text) == F.col("_kept_text_hash"))
            & (F.xxhash64(*plain) == F.col("_kept_row_hash")))
    whole = [F.col(f"`{c}`") for c in docs.columns]
    once = with_id.join(first.where("_kept_n = 1"), same).select(*whole)
    again = (with_id.join(first.where("_kept_n > 1"), same).groupBy("_kept_doc_id", "_kept_text_hash")
             .agg(F.first(F.struct(*whole)).alias("_kept_row")).select("_kept_row.*"))
    return once.unionByName(again).unionByName(docs.where(F.col("doc_id").isNull()))
