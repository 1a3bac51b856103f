"""Scored-table scan, metrics document and writers.

Writers run on the executors (a directory of part files); nothing is
collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retentio.constants import FEATURES
from retentio.operators.learn import METRICS_SCHEMA
from retentio.sources.members import read_table

_INT_FEATURES = {"Customer_Age", "Total_Trans_Ct", "Months_Inactive_12_mon", "Total_Relationship_Count",
                 "Contacts_Count_12_mon", "Months_on_book"}

SCORED_SCHEMA = T.StructType(
    [T.StructField("member_key", T.LongType())]
    + [T.StructField(f, T.IntegerType() if f in _INT_FEATURES else T.DoubleType()) for f in FEATURES]
    + [T.StructField("Card_Category", T.StringType()),
       T.StructField("Churn_Flag", T.IntegerType()),
       T.StructField("prediction", T.DoubleType()),
       T.StructField("Churn_Risk_Score", T.DoubleType()),
       T.StructField("Expected_Loss", T.DoubleType()),
       T.StructField("Priority_Score", T.DoubleType()),
       T.StructField("is_train", T.BooleanType())])
SCORED_COLUMNS = tuple(f.name for f in SCORED_SCHEMA.fields)


def read_scored(spark: SparkSession, path: str, fmt: str = "csv",
                schema: T.StructType = SCORED_SCHEMA) -> DataFrame:
    """Scored members: CSV (header, declared schema) as :func:`write_scored` writes it, or Parquet."""
    if fmt != "csv":
        return read_table(spark, path, fmt=fmt)
    # CSV columns bind by position: check the header names against the schema
    return read_table(spark, path, fmt="csv", schema=schema, enforceSchema=False)


def write_scored(scored: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Scored members, the export columns in fixed order, sorted by priority
    (desc, then key), as CSV part files (range-partitioned: part files follow
    the sort order)."""
    (scored.select(*SCORED_COLUMNS)
     .orderBy(F.col("Priority_Score").desc_nulls_last(), F.col("member_key"))
     .write.mode(mode).option("header", True).csv(path))


def write_scenarios(table: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """The scenario table: one tidy CSV with a ``Scenario`` column (a folder of parts,
    each with the header), or Parquet in one folder per scenario (readers prune by scenario)."""
    if fmt == "csv":
        table.write.mode(mode).option("header", True).csv(path)
    else:
        table.write.mode(mode).partitionBy("Scenario").parquet(path)


def replace_scenarios(table: DataFrame, path: str) -> None:
    """Replaces the scenarios that ``table`` holds in a Parquet scenario table, and no others.

    Spark moves the new folders in when all tasks are done (dynamic partition
    overwrite), so a repeat gives the same table.
    """
    (table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("Scenario").parquet(path))


def write_metrics(metrics: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The one-row metrics document as JSON (one part file)."""
    metrics.coalesce(1).write.mode(mode).json(path)


def read_metrics(spark: SparkSession, path: str, multiline: bool | None = None) -> DataFrame:
    """Metrics document with nested confusion struct and top-feature array.

    A pretty-printed single document needs ``multiLine``; part files written
    by :func:`write_metrics` are one object per line.  Auto-detect by default.
    """
    if multiline is None:
        multiline = path.endswith(".json")
    return read_table(spark, path, fmt="json", schema=METRICS_SCHEMA, multiLine=multiline)
