"""Mixing sources to target weights by Poisson replication.

Every source gets a target weight; its mean repetition rate is
``weight * total rows out / rows in``.  Each document draws a count from the
Poisson distribution with that mean by inverting the cumulative distribution
at a uniform number hashed from (seed, doc_id), is repeated that often, and
all copies are dealt out by a second hash: a global shuffle that needs no
sampling pass and repeats exactly on a retry.

Only DataFrame functions are used.  Source counts are pre-aggregated, so a
source with a third of the rows is one partial count a task; the join with
the rate table has no order or group above it, so a hot source can be split.

Weights: ``weights`` maps source to weight; by default a source with n rows
weighs n ** ``ALPHA`` (0.5 flattens, 1 keeps the proportions).  ``total`` is
the expected number of rows out, by default as many as came in.

Defined cases: a null source is a source of its own; a null doc_id draws like
the empty id; equal doc_ids draw the same count; sources absent from
``weights`` get weight 0; an empty table gives an empty result; a column of
the input that is named like an added one gives way to it (pass other names
for the added ones to keep it), all others stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentio.session import written_table

ALPHA = 0.5
SEED = 42
BROADCAST_CELLS = 1_000_000  # probabilities; 8 MB, the checked bound of the broadcast side
TWO52 = float(1 << 52)


def hash_unit(*parts: Column) -> Column:
    """Uniform in [0, 1): the first 52 bits of an md5 digest."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("long") / F.lit(TWO52)


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, total: float | None = None,
                 alpha: float = ALPHA) -> DataFrame:
    """(source, n, rate): mean repetitions a row of each source."""
    counts = docs.groupBy("source").agg(F.count("*").alias("n"))
    if weights is None:
        counts = counts.withColumn("weight", F.pow(F.col("n").cast("double"), F.lit(float(alpha))))
    else:
        pairs = [F.when(F.col("source") == k, F.lit(float(v))) for k, v in weights.items()]
        counts = counts.withColumn("weight", F.coalesce(*pairs, F.lit(0.0)))
    out = counts.agg(F.sum("n").cast("double")).scalar() if total is None else F.lit(float(total))
    all_weights = counts.agg(F.sum("weight")).scalar()
    share = F.try_divide(F.col("weight"), all_weights)
    return counts.select("source", "n", F.coalesce(share * out / F.col("n"), F.lit(0.0)).alias("rate"))


def table_length(rate: Column) -> Column:
    return F.ceil(rate + 12 * F.sqrt(rate) + 40)


def poisson_cdf(rate: Column) -> Column:
    """Cumulative probabilities of 0, 1, ... until the tail is below double precision.

    In logarithms, so that no rate underflows: log p(j) = j log(rate) - rate - log j!.
    """
    last = table_length(rate).cast("int")
    start = F.struct(F.array(F.exp(-rate)).alias("cdf"), (-rate).alias("logp"))
    step = lambda acc, j: F.struct(
        F.concat(acc["cdf"], F.array(F.element_at(acc["cdf"], -1) + F.exp(acc["logp"] + F.log(rate) - F.log(j)))).alias("cdf"),
        (acc["logp"] + F.log(rate) - F.log(j)).alias("logp"))
    return F.when(rate > 0, F.aggregate(F.transform(F.sequence(F.lit(1), last), lambda j: j.cast("double")),
                                        start, step, lambda acc: acc["cdf"])).otherwise(F.array(F.lit(1.0)))


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``docs`` is called that."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def repetitions(docs: DataFrame, rates: DataFrame, seed: int = SEED, count: str = "n_copies") -> DataFrame:
    """``docs`` with ``count``: the Poisson quantile of the document's hashed uniform number."""
    docs = docs.drop(count)
    unit, source, cdf = (free_name(docs, c) for c in ("mix_unit", "rate_source", "rate_cdf"))
    rates = written_table(rates)
    cells = rates.agg(F.sum(table_length(F.col("rate")))).first()[0] or 0
    table = rates.select(F.col("source").alias(source), poisson_cdf(F.col("rate")).alias(cdf))
    if cells <= BROADCAST_CELLS:  # beyond it the same join is shuffled, and a hot source is split
        table = F.broadcast(table)
    drawn = hash_unit(F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return (docs.withColumn(unit, drawn)
            .join(table, F.col("source").eqNullSafe(F.col(source)))
            .withColumn(count, F.size(F.filter(cdf, lambda p: p <= F.col(unit))))
            .drop(source, cdf, unit))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, total: float | None = None,
        alpha: float = ALPHA, seed: int = SEED, copy_no: str = "copy_no", mix_key: str = "mix_key") -> DataFrame:
    """Columns of ``docs`` plus ``copy_no`` (from 1) and ``mix_key``, globally shuffled by ``mix_key``."""
    spark = docs.sparkSession
    docs = docs.drop(copy_no, mix_key)
    count = free_name(docs, "n_copies")
    drawn = repetitions(docs, source_rates(docs, weights, total, alpha), seed, count).where(F.col(count) > 0)
    copies = drawn.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col(count))).alias(copy_no))
    key = hash_unit(F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                    F.col(copy_no).cast("string"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (copies.withColumn(mix_key, key).repartition(parts, mix_key)
            .sortWithinPartitions(mix_key, "doc_id", copy_no))
