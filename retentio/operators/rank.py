"""Ranking operators: global rank of every row (W1), top-K rows.

:func:`counted_rank` ranks narrow rows (group, value, key) by counted cells;
the scenario table joins its ranks back by key.  :func:`global_rank` ranks
whole rows by any order:

``row_number()`` over a window partitioned only by scenario sorts each
scenario in one task.  :func:`global_rank` keeps the sort distributed:

1. range-partition on (groups, order keys) - the bounds are sampled on the
   whole composite key, so a value shared by a third of the rows (all
   sleeping dogs share priority -1) is still split across tasks by key;
2. sort within partitions and tag each row with its partition and position;
3. cut lineage (a Parquet table in the shared checkpoint folder), so counts
   and ranks read the same rows, and the count pass reads three columns only;
4. count rows per (partition, group) - a table with one row per partition
   and group, small by construction - and turn it into offsets;
5. rank = rows in earlier partitions of the group + position + 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retentio.functions.cuts import blocked, cell, held_rows
from retentio.session import materialize


def global_rank(df: DataFrame, order_by: list[Column], group_cols=(), rank_col: str = "rank",
                num_partitions: int | None = None, how: str | None = None) -> DataFrame:
    """Dense 1..n position of every row within its group by ``order_by``.

    ``order_by`` must make the order total (end with a unique key) for the
    rank to be repeatable.
    """
    group_cols = list(group_cols)
    if how == "none":
        # counts and positions must come from the same materialised rows
        how = "persist"
    keys = [F.col(c) for c in group_cols] + list(order_by)
    # without an explicit count, adaptive execution sizes the range partitions
    # (coalescing keeps them contiguous, so the order across partitions holds)
    parted = (df.repartitionByRange(int(num_partitions), *keys) if num_partitions
              else df.repartitionByRange(*keys))
    tagged = (parted.sortWithinPartitions(*keys)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_ix", F.monotonically_increasing_id()))
    tagged = materialize(tagged, how)
    counts = tagged.groupBy("_pid", *group_cols).agg(
        F.count("*").alias("_n"), F.min("_ix").alias("_first"))
    w = (Window.partitionBy(*group_cols) if group_cols else Window).orderBy("_pid") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = counts.withColumn("_before", F.sum("_n").over(w) - F.col("_n")).drop("_n")
    # offsets: one row per (partition, group); the optimizer broadcasts it when it is small
    ranked = tagged.join(offsets, ["_pid", *group_cols])
    return (ranked.withColumn(rank_col, (F.col("_before") + F.col("_ix") - F.col("_first") + F.lit(1))
                              .cast("long"))
            .drop("_pid", "_ix", "_first", "_before"))


def counted_rank(df: DataFrame, value: str, key: str, group_cols=("Scenario",), rank_col: str = "rank",
                 pieces: int | None = None) -> DataFrame:
    """Rank of every row by (value desc, nulls last; key) within its group: (groups, key, rank).

    Quantile cuts of the value cut each group into cells, each cut value being
    a cell of its own; cells of a single value (a third of the rows may share
    one) are cut again by quantiles of the key.  Rows are counted a cell - a
    table bounded by the cuts - and sorted inside their cell only: rank = rows
    of the cells before + place in the cell.  Any cuts give exact ranks.  Only
    the groups, the value and the key are shuffled; read ``df`` from a stored
    table, as it is scanned three times, once at once for the cuts.
    """
    group_cols = list(group_cols)
    pieces = int(pieces or df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    levels = F.array(*[F.lit(k / pieces) for k in range(1, max(2, pieces))])
    accuracy = max(10_000, 20 * pieces)
    rows = df.select(*group_cols, value, key)
    numeric = isinstance(df.schema[key].dataType, T.NumericType)
    of_key = F.percentile_approx(key, levels, accuracy) if numeric else F.array().cast("array<int>")
    cuts = rows.groupBy(*group_cols).agg(F.percentile_approx(value, levels, accuracy).alias("_v"), of_key.alias("_k"))
    none = F.array()
    cuts = cuts.select(*[F.col(g).alias(f"_c{n}") for n, g in enumerate(group_cols)],
                       blocked(F.coalesce("_v", none)).alias("_v"), blocked(F.coalesce("_k", none)).alias("_k"))
    cuts = held_rows(cuts)
    on = [F.col(g).eqNullSafe(F.col(f"_c{n}")) for n, g in enumerate(group_cols)]
    # one row a group, each bounded by the number of pieces
    placed = rows.join(F.broadcast(cuts), on) if on else rows.crossJoin(F.broadcast(cuts))
    placed = placed.withColumn("_i", F.coalesce(cell(F.col(value), "_v"), F.lit(-1)))
    alone = (F.col("_i") % 2 != 0) if numeric else F.lit(False)  # one value, or none
    placed = placed.select(
        *group_cols, value, key, "_i",
        F.when(alone, F.coalesce(cell(F.col(key), "_k"), F.lit(-1))).otherwise(F.lit(0)).alias("_s"))
    counts = placed.groupBy(*group_cols, "_i", "_s").agg(F.count("*").alias("_n"))
    before = (Window.partitionBy(*group_cols) if group_cols else Window).orderBy(F.col("_i").desc(), F.col("_s")) \
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*[F.col(g).alias(f"_g{n}") for n, g in enumerate(group_cols)],
                            F.col("_i").alias("_oi"), F.col("_s").alias("_os"),
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*group_cols, "_i", "_s").orderBy(F.col(value).desc_nulls_last(), F.col(key))
    local = placed.withColumn("_at", F.row_number().over(inside))
    same = [F.col(g).eqNullSafe(F.col(f"_g{n}")) for n, g in enumerate(group_cols)]
    # a row a cell: the optimizer broadcasts them when they are few
    same += [F.col("_i") == F.col("_oi"), F.col("_s") == F.col("_os")]
    return (local.join(offsets, same)
            .select(*group_cols, key, (F.col("_before") + F.col("_at")).cast("long").alias(rank_col)))


def top_k(df: DataFrame, order_by: list[Column], k: int) -> DataFrame:
    """First k rows by ``order_by`` (TakeOrderedAndProject: a k-row heap per task)."""
    return df.orderBy(*order_by).limit(int(k))


SALTS = 32  # parts a group's rows are cut into before its top-K is taken


def top_k_per_group(df: DataFrame, group_cols, order_by: list[Column], k: int,
                    rank_col: str = "rn", key: str = "member_key") -> DataFrame:
    """First k rows per group, with their position: k per (group, salt), then k per group.

    No task sorts a whole group, whatever its size; ``key`` spreads the salts.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(SALTS)))
    first = Window.partitionBy(*group_cols, "_salt").orderBy(*order_by)
    last = Window.partitionBy(*group_cols).orderBy(*order_by)
    kept = salted.withColumn("_pos", F.row_number().over(first)).filter(F.col("_pos") <= F.lit(int(k)))
    return (kept.drop("_salt", "_pos").withColumn(rank_col, F.row_number().over(last))
            .filter(F.col(rank_col) <= F.lit(int(k))))
