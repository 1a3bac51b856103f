"""Vector codes by product quantisation: Lloyd rounds over partition-local cover trees.

Each component x becomes the integer floor(scale * x); a vector is cut into
``parts`` equal consecutive parts, each coded by its nearest codebook entry.
All distances and sums are integers, so results don't depend on order.

Trees.  A task takes its vectors in blocks of ``block`` and builds, for each
part position of a block, a cover tree: a node's points lie within its radius
of its centre, its children are centred on its own points (the first on its
own centre), lie further apart than half the node's scale and cover its points
within that half.  Points are kept in tree order, so that a subtree is one
range of them and a cumulative sum gives its sum at once.  The trees are
written as a table once; every round reads them.

Rounds.  From the root on, a node is compared with the entries at its centre:
an entry whose distance exceeds the nearest one's by more than twice the
node's radius is nearest to none of its points (triangle inequality) and is
dropped for the whole subtree.  With one entry left the subtree is assigned
whole, by its cumulative sum; only nodes that stay ambiguous are descended, at
last to exact integer comparisons of single points.  Tasks return sums for
(part, entry, position); the driver sees those few alone.

Defined cases: rows whose vector is null or empty or holds null or non-finite
components are dropped; ties of the starting entries by vec_id are cut by the
vector's value; fewer vectors than entries give fewer entries; repeated rows
are coded each; other columns than the named ones are not read; an empty
table gives an empty result.  Vectors of different lengths, lengths that
the parts don't divide and components beyond ``LIMIT`` after scaling raise
``ValueError``: the codes would mean nothing.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentio.llm.common import ship_package
from retentio.session import written_table

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
BLOCK = 4096  # vectors a tree covers
LEAF = 4  # points below which a node is not split
LIMIT = 1 << 26  # largest size of a scaled component: squared distances then fit 64 bits
SALTS = 16  # parts of a label's rows when label sums are joined by shuffle
BROADCAST_LABELS = 100_000


def build_trees(points: np.ndarray) -> dict[str, np.ndarray]:
    """Cover trees of several point sets at once; ``points``: integers (sets, n, width).

    ``order``: place in tree order -> place in the flattened input.  Node
    arrays, parents first: ``start``, ``end`` (range in tree order), ``centre``
    (place in the flattened input), ``radius``, ``child``, ``n_children``.
    """
    sets, n, width = points.shape
    flat = points.reshape(-1, width).astype(np.float64)
    order = np.arange(sets * n)
    start = np.arange(sets) * n
    end, centre = start + n, start.copy()
    out: dict[str, list] = {k: [] for k in ("start", "end", "centre", "radius", "child", "n_children")}
    made = 0  # nodes of finished levels
    scale = None
    while len(start):
        size = end - start
        node = np.repeat(np.arange(len(start)), size)  # node of each place of this level
        place = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        member = order[place]
        gap = flat[member] - flat[centre[node]]
        dist = np.sqrt((gap * gap).sum(axis=1))
        radius = np.maximum.reduceat(dist, np.cumsum(size) - size)
        split = (size > LEAF) & (radius > 0)
        if scale is None:
            scale = 2.0 ** np.ceil(np.log2(max(1.0, radius.max(initial=1.0))))
        scale /= 2
        # children: the own centre first, then the first point that no child covers yet
        child_of = np.full(len(member), -1)
        to_child = np.zeros(len(member))
        left = split[node]
        near = left & (dist <= scale)
        child_of[near], to_child[near] = 0, dist[near]
        centres = [(np.flatnonzero(split), centre[split])]
        left &= ~near
        rank = 0
        rest = np.flatnonzero(left)
        while len(rest):
            rank += 1
            owner, first = np.unique(node[rest], return_index=True)
            chosen = member[rest[first]]
            of_node = np.zeros(len(start), dtype=np.int64)
            of_node[owner] = chosen
            gap = flat[member[rest]] - flat[of_node[node[rest]]]
            d = np.sqrt((gap * gap).sum(axis=1))
            near = d <= scale
            child_of[rest[near]] = rank
            centres.append((owner, chosen))
            rest = rest[~near]
        inside = np.flatnonzero(split[node])
        sort = inside[np.lexsort((child_of[inside], node[inside]))]
        order[place[inside]] = member[sort]
        # the next level's nodes, by parent and rank
        parent = np.concatenate([c[0] for c in centres])
        ranks = np.repeat(np.arange(len(centres)), [len(c[0]) for c in centres])
        middle = np.concatenate([c[1] for c in centres])
        by = np.lexsort((ranks, parent))
        parent, middle = parent[by], middle[by]
        key = node[inside] * (rank + 1) + child_of[inside]
        counts = np.bincount(np.unique(key, return_inverse=True)[1]) if len(key) else np.zeros(0, dtype=np.int64)
        n_children = np.bincount(parent, minlength=len(start)) if len(parent) else np.zeros(len(start), np.int64)
        child = made + len(start) + np.cumsum(n_children) - n_children
        for k, v in (("start", start), ("end", end), ("centre", centre), ("radius", radius),
                     ("child", child), ("n_children", n_children)):
            out[k].append(v)
        made += len(start)
        begin = start[parent] if len(parent) else np.zeros(0, dtype=np.int64)
        before = np.cumsum(counts) - counts
        if len(parent):  # children follow each other inside their parent's range
            first_of = np.cumsum(n_children) - n_children
            begin = begin + before - before[first_of[parent]]
        start, end, centre = begin, begin + counts, middle
    tree = {k: np.concatenate(v) for k, v in out.items()}
    return {**tree, "order": order}


def unbeaten(books: np.ndarray) -> np.ndarray:
    """(parts, entries): False where an equal entry has a lower index (it never wins a tie)."""
    same = (books[:, :, None, :] == books[:, None, :, :]).all(axis=3)
    return ~np.tril(same, -1).any(axis=2)


def assign(points: np.ndarray, tree: dict[str, np.ndarray], books: np.ndarray):
    """Nearest entries, as (ranges, entry of each) and (places, entry of each) in tree order.

    ``points``: (parts, n, width) integers, ``books``: (parts, entries, width).
    Every place of the tree order is in exactly one range or single place.
    """
    parts, n, width = points.shape
    flat = points.reshape(-1, width)
    real = books.astype(np.float64)
    node = np.arange(parts)
    live = unbeaten(books)
    whole, single = [], []
    while len(node):
        centre = tree["centre"][node]
        gap = real[centre // n] - flat[centre].astype(np.float64)[:, None, :]
        dist = np.sqrt((gap * gap).sum(axis=2))
        dist[~live] = np.inf
        best = dist.min(axis=1)
        # a margin far above rounding errors: a doubtful entry stays and is compared exactly
        radius = tree["radius"][node]
        reach = 2 * radius + 1e-9 * (1 + best + radius)
        live = dist - best[:, None] <= reach[:, None]
        sure = live.sum(axis=1) == 1
        whole.append((node[sure], live[sure].argmax(axis=1)))
        leaf = ~sure & (tree["n_children"][node] == 0)
        ends = node[leaf]
        size = tree["end"][ends] - tree["start"][ends]
        single.append(np.repeat(tree["start"][ends] - (np.cumsum(size) - size), size) + np.arange(int(size.sum())))
        down = ~sure & ~leaf
        count = tree["n_children"][node[down]]
        live = np.repeat(live[down], count, axis=0)
        first = tree["child"][node[down]]
        node = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    nodes = np.concatenate([w[0] for w in whole])
    places = np.concatenate(single)
    gap = books[tree["order"][places] // n] - flat[tree["order"][places]][:, None, :]
    exact = (gap * gap).sum(axis=2).argmin(axis=1)  # the first of equal distances
    return nodes, np.concatenate([w[1] for w in whole]), places, exact


def entry_sums(points: np.ndarray, tree: dict, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(parts, entries) counts and (parts, entries, width) sums of the assigned parts."""
    parts, n, width = points.shape
    entries = books.shape[1]
    nodes, entry, places, exact = assign(points, tree, books)
    ordered = points.reshape(-1, width)[tree["order"]]
    total = np.zeros((parts * n + 1, width), dtype=np.int64)
    np.cumsum(ordered, axis=0, out=total[1:])
    start, end = tree["start"][nodes], tree["end"][nodes]
    cell = np.concatenate([start // n * entries + entry, places // n * entries + exact])
    added = np.concatenate([total[end] - total[start], ordered[places]])
    sums = np.zeros((parts * entries, width), dtype=np.int64)
    counts = np.zeros(parts * entries, dtype=np.int64)
    np.add.at(sums, cell, added)
    np.add.at(counts, cell, np.concatenate([end - start, np.ones(len(places), dtype=np.int64)]))
    return counts.reshape(parts, entries), sums.reshape(parts, entries, width)


def block_codes(points: np.ndarray, tree: dict, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n, parts) entries of every vector and its summed squared distance."""
    parts, n, width = points.shape
    nodes, entry, places, exact = assign(points, tree, books)
    found = np.empty(parts * n, dtype=np.int64)
    size = tree["end"][nodes] - tree["start"][nodes]
    at = np.repeat(tree["start"][nodes] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    found[at] = np.repeat(entry, size)
    found[places] = exact
    codes = np.empty_like(found)
    codes[tree["order"]] = found
    codes = codes.reshape(parts, n)
    gap = points - books[np.arange(parts)[:, None], codes]
    return codes.T, (gap * gap).sum(axis=(0, 2))


TREE = ("start", "end", "centre", "child", "n_children", "order")


def scaled(values, scale: int) -> np.ndarray:
    out = np.floor(scale * np.asarray(values, dtype=np.float64))
    if len(out) and np.abs(out).max() > LIMIT:
        raise ValueError(f"a scaled component exceeds {LIMIT}")
    return out.astype(np.int64)


def tree_table(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, parts: int, scale: int,
               block: int) -> DataFrame:
    """One row per block: ids, labels, points (part by part) and the arrays of its trees."""
    ship_package(vectors.sparkSession)
    id_type, label_type = (vectors.schema[c].dataType.simpleString() for c in (id_col, label_col))

    def run(batches):
        import pyarrow as pa
        held: list = []

        def row(ids, labels, flat):
            n = len(ids)
            width = len(flat) // n // parts
            points = np.ascontiguousarray(scaled(flat, scale).reshape(n, parts, width).transpose(1, 0, 2))
            tree = build_trees(points)
            cells = [pa.array([ids.to_pylist()], pa.list_(ids.type)),
                     pa.array([labels.to_pylist()], pa.list_(labels.type)),
                     pa.array([points.reshape(-1)], pa.list_(pa.int64())),
                     pa.array([tree["radius"]], pa.list_(pa.float64()))]
            cells += [pa.array([tree[k]], pa.list_(pa.int64())) for k in TREE]
            return pa.record_batch(cells, names=["ids", "labels", "points", "radius", *TREE])

        def cut(final):
            """Whole blocks from the held batches; the last one may be smaller."""
            table = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            at = 0
            while table.num_rows - at >= block or (final and at < table.num_rows):
                t = table.slice(at, block)
                yield row(t.column(0).combine_chunks(), t.column(1).combine_chunks(),
                          t.column(2).combine_chunks().flatten().to_numpy(zero_copy_only=False))
                at += block
            if at < table.num_rows:
                held.extend(table.slice(at).to_batches())

        for b in batches:
            held.append(b)
            if sum(h.num_rows for h in held) >= block:
                yield from cut(False)
        if sum(h.num_rows for h in held):
            yield from cut(True)

    arrays = ", ".join(f"{k} array<long>" for k in TREE)
    schema = f"ids array<{id_type}>, labels array<{label_type}>, points array<long>, radius array<double>, {arrays}"
    return vectors.select(id_col, label_col, F.col(vector_col).cast("array<double>")).mapInArrow(run, schema)


def _blocks(batch, parts: int):
    """(row, points, tree) of every block of an Arrow batch of the tree table."""
    for r in range(batch.num_rows):
        get = lambda k: batch.column(batch.schema.names.index(k))[r].values.to_numpy(zero_copy_only=False)
        n = len(batch.column(batch.schema.names.index("ids"))[r])
        points = get("points")
        tree = {k: get(k) for k in (*TREE, "radius")}
        yield r, points.reshape(parts, n, len(points) // (parts * n)), tree


def lloyd_round(trees: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round of assignment and replacement."""
    parts, entries, width = books.shape

    def run(batches):
        import pyarrow as pa
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for b in batches:
            for _, points, tree in _blocks(b, parts):
                c, s = entry_sums(points, tree, books)
                counts += c
                sums += s
        grid = np.indices((parts, entries, width)).reshape(3, -1)
        yield pa.record_batch([pa.array(g.astype(np.int32)) for g in grid]
                              + [pa.array(np.repeat(counts.reshape(-1), width)), pa.array(sums.reshape(-1))],
                              names=["part", "entry", "pos", "n", "total"])

    rows = (trees.select("ids", "points", "radius", *TREE)
            .mapInArrow(run, "part int, entry int, pos int, n long, total long")
            .groupBy("part", "entry", "pos")  # as many rows as the codebooks have components
            .agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
            .where("n > 0").collect())
    new = books.copy()
    for r in rows:
        new[r["part"], r["entry"], r["pos"]] = int(r["total"]) // r["n"]
    return new


def coded_blocks(trees: DataFrame, books: np.ndarray, id_type: str, label_type: str) -> DataFrame:
    """(vec_id, label, code, error) of every vector."""
    parts, entries, _ = books.shape
    digits = max(2, len(f"{entries - 1:x}"))

    def run(batches):
        import pyarrow as pa
        for b in batches:
            for r, points, tree in _blocks(b, parts):
                codes, error = block_codes(points, tree, books)
                names = np.array([f"{k:0{digits}x}" for k in range(entries)])
                text = ["".join(c) for c in names[codes]]
                yield pa.record_batch([b.column(0)[r].values, b.column(1)[r].values, pa.array(text),
                                       pa.array(error)], names=["vec_id", "label", "code", "error"])

    return trees.select("ids", "labels", "points", "radius", *TREE).mapInArrow(
        run, f"vec_id {id_type}, label {label_type}, code string, error long")


def usable_vectors(vectors: DataFrame, vector_col: str) -> DataFrame:
    """Rows whose vector has components and none of them null or non-finite."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return vectors.where((F.size(vector_col) > 0) & finite)


def encode_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
                   scale: int = SCALE, block: int = BLOCK) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, label, code, error), codebooks); see the module's docstring."""
    vectors = usable_vectors(vectors, vector_col)
    id_type, label_type = (vectors.schema[c].dataType.simpleString() for c in (id_col, label_col))
    sizes = vectors.agg(F.min(F.size(vector_col)).alias("low"), F.max(F.size(vector_col)).alias("high")).first()
    if sizes["low"] is None:
        none = vectors.sparkSession.createDataFrame(
            [], f"vec_id {id_type}, label {label_type}, code string, error long")
        return none, np.zeros((parts, 0, 0), dtype=np.int64)
    if sizes["low"] != sizes["high"] or sizes["low"] % parts:
        raise ValueError(f"vectors of {sizes['low']} to {sizes['high']} components can't be cut into {parts} parts")
    first = (vectors.where(F.col(id_col).isNotNull()).select(id_col, F.col(vector_col).cast("array<double>").alias("v"))
             .orderBy(id_col, "v").limit(entries).collect())
    if not first:  # no ids at all
        first = vectors.select(F.col(vector_col).cast("array<double>").alias("v")).orderBy("v").limit(entries).collect()
    books = np.stack([scaled(r["v"], scale).reshape(parts, -1) for r in first], axis=1)
    trees = written_table(tree_table(vectors, id_col, vector_col, label_col, parts, scale, block))
    for _ in range(rounds):
        books = lloyd_round(trees, books)
    return coded_blocks(trees, books, id_type, label_type), books


def codebooks_sha256(books: np.ndarray) -> str:
    """Digest of all components by part, entry and position."""
    return hashlib.sha256(",".join(str(int(x)) for x in books.reshape(-1)).encode()).hexdigest()


def with_label_error(coded: DataFrame) -> DataFrame:
    """Adds ``label_error``: the error summed over equal labels, nulls together.

    The sums are broadcast up to ``BROADCAST_LABELS`` labels; beyond that they
    are joined by shuffle with each label's rows cut into ``SALTS`` parts.
    """
    coded = written_table(coded)
    sums = written_table(coded.groupBy("label").agg(F.sum("error").alias("label_error")))
    if sums.count() <= BROADCAST_LABELS:
        side = F.broadcast(sums.withColumnRenamed("label", "of"))
        return coded.join(side, F.col("label").eqNullSafe(F.col("of")), "left").drop("of")
    side = sums.withColumnRenamed("label", "of").withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code", "error"), F.lit(SALTS)).cast("int"))
    return rows.join(side, F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("part")),
                     "left").drop("of", "part", "salt")
