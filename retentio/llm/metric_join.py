"""Embedding near-duplicates by an exact metric range join over pivots.

Vectors are scaled to length one; cosine >= ``MIN_COSINE`` is Euclidean
distance <= r = sqrt(2 - 2 * MIN_COSINE).  Equal vectors are first collapsed
to one row with a count.

Cells.  Pivots are vectors of a hash-ordered sample, taken greedily so that no
two are close; there is about one for each ``HOMES`` rows, and never more than
grow with the square root of the rows.  A
vector's home is the cell of its nearest pivot p.  The triangle inequality
sets the replication: if u is at home in q and within r of v, then
d(v, q) - d(v, p) <= 2r, and on the sphere the sharper form holds that v is at
most r from the plane halfway between p and q; and d(v, q) lies within r of
the home distances that occur in q.  v is copied to every cell that passes.
Each cell is then joined alone: its home vectors meet all vectors in it, so
every link of a home vector is found there and nowhere else, and nothing is
counted twice.

A cell with more than ``HOMES`` home vectors (fewer if they are long) is cut into chunks of homes, and
each chunk meets the cell's vectors in a stream of bounded batches, so that a
cell with a third of all rows neither lands in one task nor fills its memory.
A chunk returns one count a home vector and a spanning star of its links.

Defined cases: a vector that is null, of length zero, or holds a null or
non-finite component has no links and is its own component; so has one whose
number of components differs from another's towards that one; repeated rows
each get a row and link with each other; so does each vector of a vec_id that
stands on several; extra columns are not read; an empty table gives an empty
result.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentio.llm.common import connected_components, ship_package
from retentio.session import written_table

MIN_COSINE = 0.95
HOMES = 16_384  # home vectors of a chunk
HOME_NUMBERS = 1 << 23  # components of a chunk's home vectors
MET = 1 << 22  # pairs compared at once
LEAST_PIVOTS = 8
ROWS_A_PIVOT = 16  # pivots at most: square root of the rows over this
SAMPLE_A_PIVOT = 8
APART = 0.8  # least distance of two pivots
SLACK = 1e-6  # on bounds, far above rounding


def _can_link():
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite & F.exists(
        "embedding", lambda x: x != 0)


def valid_vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the rows that can link; single-precision components stay so until they are compared."""
    kind = rows.schema["embedding"].dataType.simpleString()
    vector = F.col("embedding") if kind == "array<float>" else F.col("embedding").cast("array<double>")
    return rows.select("vec_id", vector.alias("embedding")).where(_can_link())


def unit_rows(column) -> list[np.ndarray]:
    """Unit vectors of an Arrow list column; scaled by the largest component first."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.asarray(column.value_lengths()).cumsum()
    out = []
    for v in np.split(flat, ends[:-1]):
        v = v / np.abs(v).max()
        out.append(v / math.sqrt(float(v @ v)))
    return out


def choose_pivots(sample: list[np.ndarray], count: int, apart: float = APART) -> np.ndarray:
    """Greedy: each next vector that is ``apart`` from all taken ones, at least one."""
    taken: list[np.ndarray] = []
    for v in sample:
        if len(taken) >= count:
            break
        if not taken or (np.linalg.norm(np.array(taken) - v, axis=1) >= apart).all():
            taken.append(v)
    return np.array(taken)


def _matrix(column) -> np.ndarray:
    return np.stack(unit_rows(column)) if len(column) else np.zeros((0, 0))


def cell_distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (vectors @ pivots.T), 0.0))


def replicas(vectors: np.ndarray, home: np.ndarray, pivots: np.ndarray, nearest: np.ndarray, farthest: np.ndarray,
             radius: float) -> np.ndarray:
    """Boolean (vectors, cells): cells whose home vectors may be within ``radius``."""
    near = vectors @ pivots.T
    own = near[np.arange(len(vectors)), home]
    homes, which = np.unique(home, return_inverse=True)  # only the pivots that occur
    gap = np.sqrt(np.maximum(2.0 - 2.0 * (pivots[homes] @ pivots.T), 0.0))[which]
    with np.errstate(divide="ignore", invalid="ignore"):
        plane = np.where(gap > 0, (own[:, None] - near) / gap, 0.0)
    d = np.sqrt(np.maximum(2.0 - 2.0 * near, 0.0))
    reach = radius + SLACK
    ok = (plane <= reach) & (d <= farthest[None, :] + reach) & (d >= nearest[None, :] - reach)
    ok[np.arange(len(vectors)), home] = False
    return ok


class _Chunk:
    """Home vectors of one chunk, met by batches of the cell's vectors."""

    def __init__(self, min_cosine: float):
        self.min_cosine = min_cosine
        self.ids, self.vectors, self.counts = [], [], []
        self.ready = False

    def close(self) -> None:
        self.ids, self.counts = np.concatenate(self.ids), np.concatenate(self.counts)
        self.vectors = np.concatenate(self.vectors)
        self.links = np.zeros(len(self.ids), dtype=np.int64)
        self.label = np.arange(len(self.ids))
        self.ready = True
        step = self.step()
        for a in range(0, len(self.ids), step):
            self.meet(self.ids[a:a + step], self.vectors[a:a + step], self.counts[a:a + step], None, a)

    def step(self) -> int:
        """Vectors met at once."""
        return max(64, min(2048, MET // max(1, len(self.ids))))

    def meet(self, ids, vectors, counts, edges, own: int | None = None) -> None:
        linked = self.vectors @ vectors.T >= self.min_cosine
        if own is not None:
            at = np.arange(len(ids))
            linked[own + at, at] = False
        hit = np.flatnonzero(linked.any(axis=1))
        if not len(hit):
            return
        linked = linked[hit]
        self.links[hit] += linked @ counts
        cols = np.flatnonzero(linked.any(axis=0))
        linked = linked[:, cols]
        if own is not None:
            self.join(hit, own + cols, linked)
            return
        first = hit[linked.argmax(axis=0)]
        edges.append((ids[cols], first))
        # homes that share a member belong together
        self.join(hit, first, linked)

    def join(self, rows: np.ndarray, others: np.ndarray, linked: np.ndarray) -> None:
        """Smallest labels along the links between homes, until nothing changes."""
        while True:
            before = self.label.copy()
            low = np.where(linked, self.label[others][None, :], len(self.label)).min(axis=1)
            np.minimum.at(self.label, self.label[rows], low)
            self.label = np.minimum(self.label, self.label[self.label])
            low = np.where(linked, self.label[rows][:, None], len(self.label)).min(axis=0)
            np.minimum.at(self.label, self.label[others], low)
            self.label = np.minimum(self.label, self.label[self.label])
            if (before == self.label).all():
                return


def _join_cells(min_cosine: float):
    def run(batches):
        import pyarrow as pa
        chunk, key, edges = None, None, []

        def finish():
            moved = np.flatnonzero(chunk.label != np.arange(len(chunk.ids)))
            a = [chunk.ids[moved], *[e[0] for e in edges]]
            b = [chunk.ids[chunk.label[moved]], *[chunk.ids[e[1]] for e in edges]]
            a, b = np.concatenate(a), np.concatenate(b)
            return pa.record_batch([
                pa.array(np.concatenate([chunk.ids, a])), pa.array(np.concatenate([chunk.links, np.zeros(len(a), np.int64)])),
                pa.array(np.concatenate([chunk.ids, b]))], names=["rep", "links", "other"])

        for batch in batches:
            if not batch.num_rows:
                continue
            cell, part, dim, away, rep, count = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(6))
            away = away.astype(bool)
            vectors = batch.column(6)
            cut = np.flatnonzero((np.diff(cell) != 0) | (np.diff(part) != 0) | (np.diff(dim) != 0)
                                 | (np.diff(away.astype(np.int8)) != 0)) + 1
            bounds = [0, *cut.tolist(), batch.num_rows]
            for s, e in zip(bounds[:-1], bounds[1:]):
                now = (cell[s], part[s], dim[s])
                if now != key:
                    if chunk is not None and len(chunk.ids):
                        if not chunk.ready:
                            chunk.close()
                        yield finish()
                    chunk, key, edges = _Chunk(min_cosine), now, []
                if away[s] and len(chunk.ids) and not chunk.ready:
                    chunk.close()
                step = chunk.step() if chunk.ready else 2048
                for a in range(s, e, step):
                    z = min(a + step, e)
                    own = _matrix(vectors.slice(a, z - a))
                    if not away[a]:
                        chunk.ids.append(rep[a:z])
                        chunk.vectors.append(own)
                        chunk.counts.append(count[a:z])
                    elif len(chunk.ids):
                        chunk.meet(rep[a:z], own, count[a:z], edges)
        if chunk is not None and len(chunk.ids):
            if not chunk.ready:
                chunk.close()
            yield finish()
    return run


def _cells_of_dimension(vectors: DataFrame, dim: int, rows: int, radius: float) -> DataFrame:
    """(cell, part, dim, away, rep, count, vector): home rows and copies of one vector length."""
    in_chunk = max(1, min(HOMES, HOME_NUMBERS // max(1, dim)))
    count = max(LEAST_PIVOTS, min(math.ceil(rows / in_chunk), math.ceil(math.sqrt(rows) / ROWS_A_PIVOT)))
    kind = vectors.schema["vector"].dataType.simpleString()
    sample = vectors.orderBy(F.xxhash64(F.lit(7), "vector"), "vector").limit(SAMPLE_A_PIVOT * count)
    scaled = [v / np.abs(v).max() for v in (np.array(r[0]) for r in sample.select("vector").collect())]
    pivots = choose_pivots([v / np.linalg.norm(v) for v in scaled], count)

    def homes(batches):
        import pyarrow as pa
        for b in batches:
            if b.num_rows:
                d = cell_distances(_matrix(b.column(2)), pivots)
                home = d.argmin(axis=1)
                yield pa.record_batch([*b.columns, pa.array(home.astype(np.int32)),
                                       pa.array(d[np.arange(len(home)), home])],
                                      names=["rep", "count", "vector", "home", "distance"])

    placed = written_table(vectors.mapInArrow(
        homes, f"rep long, count long, vector {kind}, home int, distance double"))
    sizes = {r["home"]: r for r in placed.groupBy("home").agg(  # a row a pivot
        F.count("*").alias("n"), F.min("distance").alias("low"), F.max("distance").alias("high")).collect()}
    cells = range(len(pivots))
    low = np.array([sizes[c]["low"] if c in sizes else np.inf for c in cells])
    high = np.array([sizes[c]["high"] if c in sizes else -np.inf for c in cells])
    chunks = np.array([-(-sizes[c]["n"] // in_chunk) if c in sizes else 0 for c in cells])

    def deal(batches):
        import pyarrow as pa
        for whole in batches:
            for a in range(0, whole.num_rows, 1024):
                b = whole.slice(a, 1024)
                rep = b.column(0).to_numpy(zero_copy_only=False)
                home = b.column(3).to_numpy(zero_copy_only=False)
                vectors = _matrix(b.column(2))
                own = ((rep.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64)
                own = own % chunks[home]
                row, cell = np.nonzero(replicas(vectors, home, pivots, low, high, radius))
                # a home row meets the other chunks of its own cell as a copy
                row = np.concatenate([np.repeat(row, chunks[cell]), np.repeat(np.arange(len(rep)), chunks[home])])
                part_of = lambda n: np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                n_far = chunks[cell]
                part = np.concatenate([part_of(n_far), part_of(chunks[home])])
                cell = np.concatenate([np.repeat(cell, n_far), np.repeat(home, chunks[home])])
                away = (cell != home[row]) | (part != own[row])
                for s in range(0, len(row), 8192):
                    at = slice(s, s + 8192)
                    take = pa.array(row[at])
                    yield pa.record_batch([
                        pa.array(cell[at].astype(np.int32)), pa.array(part[at].astype(np.int32)),
                        pa.array(np.full(len(row[at]), dim, dtype=np.int32)), pa.array(away[at]),
                        b.column(0).take(take), b.column(1).take(take), b.column(2).take(take)],
                        names=["cell", "part", "dim", "away", "rep", "count", "vector"])

    return placed.mapInArrow(
        deal, f"cell int, part int, dim int, away boolean, rep long, count long, vector {kind}")


def near_duplicates(rows: DataFrame, min_cosine: float = MIN_COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``rows``."""
    spark = rows.sparkSession
    ship_package(spark)
    radius = math.sqrt(2 - 2 * min_cosine)
    valid = valid_vectors(rows)
    # equal vectors: one row each, named by a number of its own, as a vec_id may stand on several vectors
    distinct = written_table(valid.groupBy(F.col("embedding").alias("vector")).agg(
        F.min("vec_id").alias("smallest"), F.count("*").alias("count"))
        .select(F.monotonically_increasing_id().alias("rep"), "smallest", "count", "vector"))
    dims = {r[0]: r[1] for r in distinct.groupBy(F.size("vector")).count().collect()}  # a row a vector length
    empty = spark.createDataFrame([], "rep long, links long, other long")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = empty
    for dim, n in sorted(dims.items()):
        of_dim = distinct.where(F.size("vector") == dim).select("rep", "count", "vector")
        cells = _cells_of_dimension(of_dim, dim, n, radius)
        dealt = cells.repartition(parts, "cell", "part", "dim").sortWithinPartitions("cell", "part", "dim", "away")
        found = found.unionByName(dealt.mapInArrow(_join_cells(min_cosine), "rep long, links long, other long"))
    found = written_table(found)
    roots = connected_components(found.where("rep <> other").select(F.col("rep").alias("a"), F.col("other").alias("b")))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    labelled = written_table(
        distinct.select("rep", "smallest", "count").join(links, "rep", "left")
        .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
        .select("rep", "smallest", (F.coalesce("links", F.lit(0)) + F.col("count") - 1).alias("n_links"),
                F.coalesce("root", "rep").alias("root")))
    smallest = written_table(labelled.groupBy("root").agg(F.min("smallest").alias("component_id")))
    classes = written_table(labelled.join(smallest, "root").select("rep", "n_links", "component_id"))
    named = distinct.select("vector", "rep").join(classes, "rep").select("vector", "n_links", "component_id")
    linked = valid.join(written_table(named), valid["embedding"] == F.col("vector")).select(
        "vec_id", "n_links", "component_id")
    alone = rows.select("vec_id", F.col("embedding"))
    rest = alone.where(~F.coalesce(_can_link(), F.lit(False))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
