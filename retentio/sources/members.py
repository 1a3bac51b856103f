"""Member tables: the raw member CSV/Parquet scan and the stand-in built from
the order tables.

The stand-in derives one row per customer with the same columns a member
file carries: 12 behaviour features, the card tier and the attrition flag.
Features use the 12 months before a cutoff, the label the 4 months after it,
so no feature sees the label period.
"""

from __future__ import annotations

import csv
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retentio.constants import CHURNED_LABEL, DROP_COLUMNS
from retentio.session import table_path

# ---- FIXED VALUES: stand-in windows (cutoff year/month and window bounds) ----
CUTOFF_YEAR, CUTOFF_MONTH = 2000, 6
FEATURE_START = "1999-06-01 00:00:00"   # 12 months of behaviour
Q1_END = "1999-09-01 00:00:00"          # first quarter of that year
Q4_START = "2000-03-01 00:00:00"        # last quarter of that year
CUTOFF = "2000-06-01 00:00:00"
LABEL_END = "2000-10-01 00:00:00"       # 4 months of label period
URGENT_PRIORITY = "1-URGENT"
RETURNED_FLAG = "R"
BASE_CREDIT, CREDIT_PER_BALANCE = 1438.0, 3.0
AGE_BASE, AGE_MULT, AGE_SPAN = 26, 37, 48
AMOUNT_SCALE = 20.0

RAW_MEMBER_SCHEMA = T.StructType([
    T.StructField("CLIENTNUM", T.LongType()),
    T.StructField("Attrition_Flag", T.StringType()),
    T.StructField("Customer_Age", T.IntegerType()),
    T.StructField("Card_Category", T.StringType()),
    T.StructField("Months_on_book", T.IntegerType()),
    T.StructField("Total_Relationship_Count", T.IntegerType()),
    T.StructField("Months_Inactive_12_mon", T.IntegerType()),
    T.StructField("Contacts_Count_12_mon", T.IntegerType()),
    T.StructField("Credit_Limit", T.DoubleType()),
    T.StructField("Total_Revolving_Bal", T.DoubleType()),
    T.StructField("Total_Amt_Chng_Q4_Q1", T.DoubleType()),
    T.StructField("Total_Trans_Amt", T.DoubleType()),
    T.StructField("Total_Trans_Ct", T.IntegerType()),
    T.StructField("Total_Ct_Chng_Q4_Q1", T.DoubleType()),
    T.StructField("Avg_Utilization_Ratio", T.DoubleType()),
])


# Declared input schemas (only the columns the member table reads): no footer
# inference job per scan, and the scan reads these columns only.
LINEITEM_SCHEMA = T.StructType([
    T.StructField("l_orderkey", T.LongType()),
    T.StructField("l_extendedprice", T.DoubleType()),
    T.StructField("l_returnflag", T.StringType()),
    T.StructField("l_shipdate", T.TimestampNTZType()),
])
ORDERS_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()),
    T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderpriority", T.StringType()),
])
CUSTOMER_SCHEMA = T.StructType([
    T.StructField("c_custkey", T.LongType()),
    T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType()),
])


class MissingInputError(FileNotFoundError):
    """Raised when an input path does not exist (clear message with the path)."""


def _ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | None = None, header: bool = True, **options) -> DataFrame:
    """Scan a table (``options`` go to the reader); a missing path raises MissingInputError naming it."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", header)
    try:
        return reader.options(**options).format(fmt).load(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise MissingInputError(f"input not found: {path}") from exc
        raise


def read_member_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_MEMBER_SCHEMA,
                    fmt: str = "csv") -> DataFrame:
    """Raw member file or folder of parts, columns bound by name.

    CSV columns bind by position, so the header is read first (one line) and
    gives the order; names in ``schema`` get its types, others are read as
    text and dropped.  A name of the schema that the header lacks is an error.
    ``fmt`` is "csv" or "parquet".
    """
    if fmt != "csv":
        return read_table(spark, path, fmt=fmt)
    known, layout = _csv_layout(spark, path, schema)
    rows = read_table(spark, path, fmt="csv", schema=layout, enforceSchema=False)
    return rows.select(*[F.col(f"`{c}`").alias(n) for n, c in known.items()])


BOM = "\ufeff"  # may stand before the header line
BAD_LINE = "_bad_line"


def _csv_layout(spark: SparkSession, path: str, schema: T.StructType) -> tuple[dict[str, str], T.StructType]:
    """({name of the schema: column of the file}, types of the file's columns in the header's order)."""
    lines = read_table(spark, path, fmt="text").limit(1).collect()
    header = next(csv.reader([lines[0][0]])) if lines else []
    types = {f.name: f.dataType for f in schema.fields}
    plain = [n.lstrip(BOM).strip('"') if i == 0 else n for i, n in enumerate(header)]
    missing = [n for n in types if n not in plain]
    if missing:
        raise ValueError(f"columns missing in {path}: {', '.join(missing)}")
    layout = T.StructType([T.StructField(h, types.get(n, T.StringType())) for h, n in zip(header, plain)])
    return {n: header[plain.index(n)] for n in types}, layout


def _ddl(schema: T.StructType) -> str:
    quoted = [f.name.replace("`", "``") for f in schema.fields]
    return ", ".join(f"`{n}` {f.dataType.simpleString()}" for n, f in zip(quoted, schema.fields))


def read_member_csv_with_rejects(spark: SparkSession, path: str,
                                 schema: T.StructType = RAW_MEMBER_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """S1 with its losses: (members, rejects).

    A line with a cell that its type can't hold, or with more or fewer cells
    than the header, is no member: it stands in the rejects as (file, line).
    A mark of byte order before the header is skipped.
    """
    known, layout = _csv_layout(spark, path, schema)
    layout = T.StructType([*layout.fields, T.StructField(BAD_LINE, T.StringType())])
    raw = read_table(spark, path, fmt="text").select(
        F.ltrim(F.col("value"), F.lit(BOM)).alias("line"), F.col("_metadata.file_path").alias("file"))
    header = read_table(spark, path, fmt="text").limit(1).collect()[0][0].lstrip(BOM)
    # each file begins with the header; lines are parsed by themselves, all cells of each
    raw = raw.filter((F.col("line") != F.lit(header)) & (F.trim("line") != F.lit("")))
    how = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE}
    rows = raw.withColumn("cells", F.from_csv("line", _ddl(layout), how))
    bad = F.col("cells").getField(BAD_LINE).isNotNull()
    good = rows.filter(~bad).select(*[F.col("cells").getField(c).alias(n) for n, c in known.items()])
    return good, rows.filter(bad).select("file", "line")


def drop_unused(df: DataFrame, columns=DROP_COLUMNS, keep_key: str | None = "CLIENTNUM") -> DataFrame:
    """Drop the id and leaked score columns by name (absent names are ignored).

    The business key is kept aside as ``member_key`` for stable ids and
    tie-breaks rather than thrown away.
    """
    if keep_key and keep_key in df.columns and "member_key" not in df.columns:
        df = df.withColumn("member_key", F.col(keep_key).cast("long"))
    return df.drop(*columns)


def with_churn_flag(df: DataFrame) -> DataFrame:
    """Churn_Flag = 1 when Attrition_Flag is the churned label, else 0."""
    return df.withColumn(
        "Churn_Flag",
        F.when(F.col("Attrition_Flag") == F.lit(CHURNED_LABEL), F.lit(1)).otherwise(F.lit(0)))


def with_rule_risk(df: DataFrame) -> DataFrame:
    """Deterministic stand-in churn risk in [0, 1], rounded to 4 places.

    Lets every operator downstream of the model have an exact SQL oracle; the
    learned risk replaces it in the model path.
    """
    inactive = F.col("Months_Inactive_12_mon")
    ct = F.col("Total_Trans_Ct")
    chg = F.col("Total_Ct_Chng_Q4_Q1")
    raw = (F.lit(0.06) * inactive
           + F.lit(0.04) * F.greatest(F.lit(0), F.lit(12) - ct)
           + F.lit(0.20) * F.greatest(F.lit(0.0), F.lit(1.0) - chg)
           - F.lit(0.10))
    return df.withColumn(
        "Churn_Risk_Score", F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.round(raw, 4))))


def _cents(price: str) -> Column:
    """Price as whole cents (long), equal to the decimal(18,2) cast of the double.

    Prices on a cent grid take the fast path (scale and round, no decimal
    object per row); anything else goes through the exact decimal cast.
    """
    x100 = F.col(price) * F.lit(100.0)
    exact = F.col(price).cast("decimal(18,2)") * F.lit(100)
    return (F.when(F.abs(x100 - F.rint(x100)) < F.lit(1e-6), F.rint(x100))
            .otherwise(exact)).cast("long")


def _order_activity(lineitem: DataFrame) -> DataFrame:
    """One row per order: line counts and amounts (cents) per window.

    Lines of one order sit together in the file, so the map-side partial
    aggregate already folds them before the shuffle on the order key.
    """
    d = F.col("l_shipdate")
    amt = _cents("l_extendedprice")
    zero = F.lit(0).cast("long")
    in12 = (d >= _ts(FEATURE_START)) & (d < _ts(CUTOFF))
    inq4 = (d >= _ts(Q4_START)) & (d < _ts(CUTOFF))
    inq1 = (d >= _ts(FEATURE_START)) & (d < _ts(Q1_END))
    before = d < _ts(CUTOFF)
    future = d >= _ts(CUTOFF)
    months_back = ((F.lit(CUTOFF_YEAR) - F.year(d)) * F.lit(12)
                   + F.lit(CUTOFF_MONTH) - F.month(d))
    # lines after the label period say nothing: the scan skips them (a pushed filter on the date)
    # conditions and derived values once per line, then plain aggregates
    lines = lineitem.filter(d < _ts(LABEL_END)).select(
        "l_orderkey",
        in12.alias("in12"), inq4.alias("inq4"), inq1.alias("inq1"), future.alias("fut"),
        (in12 & (F.col("l_returnflag") == F.lit(RETURNED_FLAG))).alias("ret12"),
        amt.alias("cents"),
        F.when(before, months_back).alias("back"),
    )
    return lines.groupBy("l_orderkey").agg(
        F.count_if("in12").alias("ct"),
        F.sum(F.when(F.col("in12"), F.col("cents")).otherwise(zero)).alias("amt"),
        F.count_if("ret12").alias("contacts"),
        F.count_if("inq4").alias("q4"),
        F.count_if("inq1").alias("q1"),
        F.sum(F.when(F.col("inq4"), F.col("cents")).otherwise(zero)).alias("a4"),
        F.sum(F.when(F.col("inq1"), F.col("cents")).otherwise(zero)).alias("a1"),
        F.min("back").alias("back_min"),
        F.max("back").alias("back_max"),
        F.count_if("fut").alias("fut"),
    )


def _customer_activity(order_activity: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per customer from its orders' activity.

    Cent totals are summed as decimal(38,0): exact, and no overflow even if
    one customer holds a large share of all lines.
    """
    o = orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    j = order_activity.join(o, order_activity["l_orderkey"] == o["o_orderkey"])
    pri = F.col("o_orderpriority")

    def cents_sum(c):
        return F.sum(F.col(c).cast("decimal(38,0)")).alias(c)

    return j.groupBy(F.col("o_custkey").alias("k")).agg(
        F.sum("ct").alias("ct"),
        cents_sum("amt"),
        F.sum("contacts").alias("contacts"),
        F.sum("q4").alias("q4"),
        F.sum("q1").alias("q1"),
        cents_sum("a4"),
        cents_sum("a1"),
        F.min("back_min").alias("inactive_raw"),
        F.max(F.when(pri == F.lit(URGENT_PRIORITY), F.col("back_max"))).alias("mob_raw"),
        # distinct priorities among orders with a line before the cutoff.
        # Planned as two codegen hash aggregates, both combining map-side
        # (by customer and priority, then by customer), so a hot customer is
        # folded before each shuffle; collect_set would run in an object
        # aggregate that falls back to sorting once a task holds >128 keys.
        F.countDistinct(F.when(F.col("back_min").isNotNull(), pri)).alias("rel"),
        F.sum("fut").alias("fut"),
    )


def _money(cents: Column) -> Column:
    """Cents to a double amount (correctly rounded, like a decimal-to-double cast)."""
    return cents.cast("double") / F.lit(100.0)


def order_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lineitem, orders, customer): the columns that the member table reads."""
    schemas = {"lineitem": LINEITEM_SCHEMA, "orders": ORDERS_SCHEMA, "customer": CUSTOMER_SCHEMA}
    return tuple(read_table(spark, table_path(sf_dir, n), schema=t) for n, t in schemas.items())


def write_bucketed_orders(spark: SparkSession, sf_dir: str, database: str, path: str, buckets: int) -> None:
    """The order lines and orders as tables of ``database`` under ``path``, in ``buckets`` buckets by order key.

    Member tables over :func:`bucketed_order_tables` then aggregate the lines
    and join the orders without a shuffle of either.
    """
    spark.sql(f"create database if not exists {database}")
    lineitem, orders, _ = order_tables(spark, sf_dir)
    for name, df, key in (("lineitem", lineitem, "l_orderkey"), ("orders", orders, "o_orderkey")):
        (df.repartition(int(buckets), key).write.mode("overwrite").option("path", f"{path.rstrip('/')}/{name}")
         .bucketBy(int(buckets), key).sortBy(key).saveAsTable(f"{database}.{name}"))


def bucketed_order_tables(spark: SparkSession, sf_dir: str, database: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Like :func:`order_tables`, with the bucketed lines and orders of ``database``."""
    return (spark.table(f"{database}.lineitem"), spark.table(f"{database}.orders"), order_tables(spark, sf_dir)[2])


def member_table(spark: SparkSession, sf_dir: str, with_risk: bool = True) -> DataFrame:
    """Stand-in member table (one row per customer with activity up to the end of the label period)."""
    return members_from_orders(*order_tables(spark, sf_dir), with_risk)


def members_from_orders(lineitem: DataFrame, orders: DataFrame, customer: DataFrame,
                        with_risk: bool = True) -> DataFrame:
    """The member table of any order tables; bucketed ones by order key join without a shuffle."""
    f = _customer_activity(_order_activity(lineitem), orders)
    c = customer.select("c_custkey", "c_acctbal", "c_mktsegment")
    j = c.join(f, c["c_custkey"] == f["k"])

    bal = F.greatest(F.col("c_acctbal"), F.lit(0.0))
    credit = F.lit(BASE_CREDIT) + F.lit(CREDIT_PER_BALANCE) * bal
    members = j.select(
        F.col("c_custkey").alias("member_key"),
        (F.lit(AGE_BASE) + (F.col("c_custkey") * F.lit(AGE_MULT)) % F.lit(AGE_SPAN))
        .cast("int").alias("Customer_Age"),
        credit.alias("Credit_Limit"),
        (bal / F.lit(4.0)).alias("Total_Revolving_Bal"),
        (_money(F.col("amt")) / F.lit(AMOUNT_SCALE)).alias("Total_Trans_Amt"),
        F.col("ct").cast("int").alias("Total_Trans_Ct"),
        F.least(F.lit(12), F.coalesce(F.col("inactive_raw"), F.lit(12)))
        .cast("int").alias("Months_Inactive_12_mon"),
        F.greatest(F.lit(1), F.col("rel")).cast("int").alias("Total_Relationship_Count"),
        ((F.col("q4") + F.lit(1)).cast("double") / (F.col("q1") + F.lit(1)).cast("double"))
        .alias("Total_Ct_Chng_Q4_Q1"),
        (_money(F.col("a4") + F.lit(100)) / _money(F.col("a1") + F.lit(100)))
        .alias("Total_Amt_Chng_Q4_Q1"),
        ((bal / F.lit(4.0)) / credit).alias("Avg_Utilization_Ratio"),
        F.col("contacts").cast("int").alias("Contacts_Count_12_mon"),
        F.coalesce(F.col("mob_raw"), F.lit(0)).cast("int").alias("Months_on_book"),
        F.col("c_mktsegment").alias("Card_Category"),
        F.when(F.col("fut") == F.lit(0), F.lit(CHURNED_LABEL))
        .otherwise(F.lit("Existing Customer")).alias("Attrition_Flag"),
    )
    members = with_churn_flag(members)
    return with_rule_risk(members) if with_risk else members
