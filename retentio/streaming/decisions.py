"""Per-member decisions over a stream of member snapshots.

The decision chain D1-D6 is row-local (no population scalar, no ranking), so
the same functions run unchanged on a streaming DataFrame: new member files
landing in a folder are scored as they arrive and appended to a sink, with
exactly-once output through the checkpoint location.  Population-wide steps
(normalised value, sweep, rank) need the whole table and stay batch jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from retentio.constants import DEFAULT_MARGIN
from retentio.operators.decide import Costs, decide

MEMBER_SCHEMA = T.StructType([
    T.StructField("member_key", T.LongType()),
    T.StructField("Customer_Age", T.IntegerType()),
    T.StructField("Credit_Limit", T.DoubleType()),
    T.StructField("Total_Revolving_Bal", T.DoubleType()),
    T.StructField("Total_Trans_Amt", T.DoubleType()),
    T.StructField("Total_Trans_Ct", T.IntegerType()),
    T.StructField("Months_Inactive_12_mon", T.IntegerType()),
    T.StructField("Total_Relationship_Count", T.IntegerType()),
    T.StructField("Total_Ct_Chng_Q4_Q1", T.DoubleType()),
    T.StructField("Total_Amt_Chng_Q4_Q1", T.DoubleType()),
    T.StructField("Avg_Utilization_Ratio", T.DoubleType()),
    T.StructField("Contacts_Count_12_mon", T.IntegerType()),
    T.StructField("Months_on_book", T.IntegerType()),
    T.StructField("Card_Category", T.StringType()),
    T.StructField("Attrition_Flag", T.StringType()),
    T.StructField("Churn_Flag", T.IntegerType()),
    T.StructField("Churn_Risk_Score", T.DoubleType()),
])

DECISION_COLUMNS = ("member_key", "Recommended_Action", "Net_ROI", "Expected_Value_Saved",
                    "Value_At_Stake", "Save_Prob", "Is_Sleeping_Dog", "Total_Account_Value")


def decision_stream(members: DataFrame, margin: float = DEFAULT_MARGIN,
                    costs: Costs = Costs()) -> DataFrame:
    """Row-local decisions; works on a batch or a streaming DataFrame."""
    return decide(members, margin, costs).select(*DECISION_COLUMNS)


def start_decision_stream(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_location: str,
                          margin: float = DEFAULT_MARGIN, costs: Costs = Costs(),
                          schema: T.StructType = MEMBER_SCHEMA, available_now: bool = True,
                          max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Score member Parquet files as they land in ``source_dir``; append to ``sink_dir``.

    ``available_now`` processes everything present and stops (batch-like,
    restartable from the checkpoint); otherwise the query keeps running.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    members = reader.parquet(source_dir)
    out = decision_stream(members, margin, costs).withColumn("scored_at", F.current_timestamp())
    writer = (out.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start(sink_dir)
