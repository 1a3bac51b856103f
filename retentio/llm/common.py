"""Helpers shared by the corpus operators: shipping, slicing, lineage cuts, components."""

from __future__ import annotations

import os
import tempfile
import zipfile

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retentio.session import written_table

PACKAGE_DIR = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the executors' Python workers, once per application.

    Worker functions are pickled by reference, so a worker must be able to
    import them; ``addPyFile`` sends the sources whatever the cluster's paths.
    """
    sc = spark.sparkContext
    if getattr(sc, "_retentio_shipped", False):
        return
    target = os.path.join(tempfile.mkdtemp(prefix="retentio-src-"), "retentio_src.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(PACKAGE_DIR):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(PACKAGE_DIR)))
    sc.addPyFile(target)
    sc._retentio_shipped = True


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column; null is empty."""
    import pyarrow as pa
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def byte_slices(texts: list[bytes], limit: int = 1 << 19):
    """Ranges (i, j) of whole texts whose sizes add up to about ``limit`` bytes."""
    i = size = 0
    for j, t in enumerate(texts):
        size += len(t) + 1
        if size >= limit:
            yield i, j + 1
            i, size = j + 1, 0
    if i < len(texts):
        yield i, len(texts)


def held_out_expr(column: str = "doc_id"):
    """Rows never learnt from: crc32 of the id as text, mod 5, is 0."""
    return F.crc32(F.col(column).cast("string")) % 5 == 0


FIT_BYTES = 1 << 16  # longest text of a fit row: a few rows must not fill the driver


def training_rows(docs: DataFrame, columns: list[str], limit: int, labels: DataFrame | None = None,
                  label: str | None = None, condition=None, seed: int = 42, max_bytes: int = FIT_BYTES) -> list:
    """At most ``limit`` labelled rows, chosen by a hash of doc_id (documented bound of a fit).

    Chosen rows whose text is longer than ``max_bytes`` are left out, so that
    the bound holds in bytes too: limit x max_bytes at most.

    ``columns`` come from ``docs`` and ``label`` from ``labels``, whatever else
    the two hold.  Only ids are ordered; the rows of the chosen ids are then
    read with an ``isin`` filter.  A doc_id that occurs more than once gives its
    smallest row, before anything reaches the driver.
    """
    ids = (docs if labels is None else labels).where(F.col("doc_id").isNotNull())
    if condition is not None:
        ids = ids.where(condition)
    chosen = [r[0] for r in ids.select("doc_id").distinct()
              .orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(limit).collect()]
    return _rows_of(chosen, docs, columns, ids, labels, label, max_bytes)


def rows_by_label(docs: DataFrame, columns: list[str], label: str, limit: int, condition, seed: int = 42,
                  max_bytes: int = FIT_BYTES) -> list:
    """Like :func:`training_rows` with at most ``limit`` rows of each value of ``docs[label]``.

    A task hands on at most ``limit`` ids a value (up to 1000, see Spark's
    window group limit); a doc_id counts for its smallest value.
    """
    ids = docs.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & condition)
    first = Window.partitionBy("value").orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id")
    chosen = (ids.groupBy("doc_id").agg(F.min(label).alias("value"))
              .withColumn("place", F.row_number().over(first)).where(F.col("place") <= limit).select("doc_id").collect())
    return _rows_of([r[0] for r in chosen], docs, columns, ids, None, None, max_bytes)


def _rows_of(chosen: list, docs: DataFrame, columns: list[str], ids: DataFrame, labels: DataFrame | None,
             label: str | None, max_bytes: int) -> list:
    mine = F.col("doc_id").isin(chosen)
    short = F.octet_length(F.coalesce(F.col("text"), F.lit(""))) <= max_bytes if "text" in columns else F.lit(True)
    rows = (ids if labels is None else docs).where(mine & short).groupBy("doc_id").agg(
        F.min(F.struct(*columns)).alias("row")).select("doc_id", "row.*")
    if labels is not None:  # at most ``limit`` rows
        rows = rows.join(F.broadcast(ids.where(mine).groupBy("doc_id").agg(F.min(label).alias(label))), "doc_id")
    return sorted(rows.collect(), key=lambda r: r["doc_id"])


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of an undirected graph given as (a, b) rows; returns (node, root).

    Each round every node points to the neighbour with the smallest hashed
    priority (itself included), and the graph is contracted along the
    pointers.  A component that has shrunk to one node drops out, so its hub
    never meets the next round; hashed priorities shrink long chains by a
    constant factor a round.  Every step is an aggregate or a plain equi-join
    on written tables, which adaptive execution splits when a key is hot.
    Nodes that occur in no edge are not returned; ``root`` is some node of
    the component, the same for all of it.
    """
    rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("n"))
    tidy = lambda e: (e.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                      .distinct())
    live = written_table(tidy(edges))
    steps: list[DataFrame] = []
    while not live.isEmpty():
        both = live.select(F.col("a").alias("node"), rank("b").alias("to")).unionAll(
            live.select(F.col("b").alias("node"), rank("a").alias("to")))
        step = both.groupBy("node").agg(F.min("to").alias("to")).select(
            "node", F.least("to", rank("node")).getField("n").alias("root"))
        step = written_table(step)
        steps.append(step)
        moved = (live.join(step.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a")
                 .join(step.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b")
                 .select(F.col("ra").alias("a"), F.col("rb").alias("b")))
        live = written_table(tidy(moved))
    if not steps:
        return live.select(F.col("a").alias("node"), F.col("b").alias("root"))
    final = steps[-1]
    for step in reversed(steps[:-1]):
        later = final.select(F.col("node").alias("root"), F.col("root").alias("next"))
        final = (step.join(later, "root", "left")
                 .select("node", F.coalesce("next", "root").alias("root")))
    return written_table(final) if len(steps) > 1 else final


def link_components(linked: np.ndarray) -> np.ndarray:
    """Smallest member index of each row's component in a symmetric boolean matrix."""
    n = len(linked)
    label = np.arange(n)
    while True:
        best = np.where(linked, label[None, :], n).min(axis=1, initial=n)
        new = np.minimum(label, best)
        new = new[new]
        if (new == label).all():
            return label
        label = new
