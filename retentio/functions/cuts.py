"""Cut values: place a number among sorted cuts without a join or a sort of the rows.

Cuts are an array column (one a group).  They are held in blocks, so that a
row is compared with the last cut of each block and then with one block.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK = 16


def blocked(cuts: Column) -> Column:
    """struct(all cuts ascending, last cut of every full block) of an array of cuts."""
    own = F.array_sort(F.array_distinct(cuts))
    lasts = F.transform(F.sequence(F.lit(1), F.floor(F.size(own) / F.lit(BLOCK)).cast("int")),
                        lambda k: F.get(own, k * BLOCK - 1))
    return F.struct(own.alias("cuts"),
                    F.when(F.size(own) >= BLOCK, lasts).otherwise(F.slice(own, 1, 0)).alias("lasts"))


def cell(x: Column, held: str | Column) -> Column:
    """2k + 1 on the k-th cut (from 0), else twice the number of cuts below; null for null."""
    held = F.col(held) if isinstance(held, str) else held
    skipped = F.size(F.filter(held["lasts"], lambda c: c < x)) * BLOCK
    block = F.slice(held["cuts"], skipped + 1, F.lit(BLOCK))
    below = skipped + F.size(F.filter(block, lambda c: c < x))
    return F.when(x.isNotNull(), 2 * below + F.coalesce(F.get(held["cuts"], below) == x, F.lit(False)).cast("int"))


def constant_rows(spark: SparkSession, rows: list[dict], schema: T.StructType) -> DataFrame:
    """A few known rows as a constant of the plan (no Python worker, no job)."""
    values = F.from_json(F.lit(json.dumps(rows, default=str)), T.ArrayType(schema))
    return spark.range(1).select(F.inline(values))


def held_rows(df: DataFrame) -> DataFrame:
    """``df``, a table of a few rows such as the cuts, evaluated once and held as a constant.

    Quantile sketches may differ from run to run; two readers of one plan must
    see the same cuts.
    """
    return constant_rows(df.sparkSession, [r.asDict(recursive=True) for r in df.collect()], df.schema)
