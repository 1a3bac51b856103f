"""Population scalars (J3/A6), loyalty weight (D7) and priority.

Population min/max are one aggregate per scenario, joined back by a
broadcast on ``Scenario``.  That side has one row per scenario of the
driver-side parameter list, so its size is bounded by construction; no
unpartitioned window pulls the whole table into one task.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retentio.constants import DEFAULT_LOYALTY, SCENARIOS
from retentio.operators.decide import RISK, Costs, decide_scenarios
from retentio.sources.members import MissingInputError
from retentio.functions.scalar import min_max_scale

GROUP = ("Scenario",)


def population_scalars(df: DataFrame, group_cols=GROUP) -> DataFrame:
    """min/max tenure and max account value per scenario (one row each)."""
    return df.groupBy(*group_cols).agg(
        F.min("Months_on_book").alias("pop_min_mob"),
        F.max("Months_on_book").alias("pop_max_mob"),
        F.max("Total_Account_Value").alias("pop_max_value"),
    )


def population_state(df: DataFrame, group_cols=GROUP) -> DataFrame:
    """The scalars, and the members, those with an age and their ages' sum: all merge by min, max or sum."""
    return df.groupBy(*group_cols).agg(
        F.min("Months_on_book").alias("pop_min_mob"), F.max("Months_on_book").alias("pop_max_mob"),
        F.max("Total_Account_Value").alias("pop_max_value"), F.count("*").alias("pop_n"),
        F.count("Customer_Age").alias("pop_n_age"), F.sum("Customer_Age").alias("pop_age"))


def merge_states(partials: DataFrame, group_cols=GROUP) -> DataFrame:
    """One ``population_state`` row a group from the states of parts."""
    how = {"pop_min_mob": F.min, "pop_max_mob": F.max, "pop_max_value": F.max, "pop_n": F.sum, "pop_n_age": F.sum,
           "pop_age": F.sum}
    return partials.groupBy(*group_cols).agg(*[f(c).alias(c) for c, f in how.items()])


def _file_id():
    m = F.col("_metadata")
    return F.md5(F.concat_ws("|", m["file_path"], m["file_modification_time"].cast("string"), m["file_size"].cast("string")))


def refresh_state(spark: SparkSession, member_path: str, state_path: str, scenarios=SCENARIOS,
                  costs: Costs = Costs()) -> tuple[DataFrame, list[str]]:
    """The population's state by scenario, kept as one partial state a member file.

    ``member_path`` is a folder of Parquet member files.  Files without a
    stored partial (told by path, time and size) are read and theirs are
    added; partials of files that are gone or were rewritten no longer count,
    so a maximum that left with its file is found again from the others.
    Writing a file's partial twice gives the same folder, so a failed refresh
    can be repeated.  Returns (state, files that were read).
    """
    # file names, times and sizes: no file is opened
    listed = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
              .load(member_path).select(_file_id().alias("file_id"), F.col("_metadata.file_path").alias("file")))
    now = {r.file_id: r.file for r in listed.collect()}
    try:
        stored = spark.read.parquet(state_path)
        known = {r.file_id for r in stored.select("file_id").distinct().collect()}
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc) and "UNABLE_TO_INFER_SCHEMA" not in str(exc):
            raise
        known = set()
    new = sorted(f for i, f in now.items() if i not in known)
    if new:
        rows = spark.read.parquet(*new)
        rows = rows.select("*", _file_id().alias("file_id"))
        part = population_state(decide_scenarios(rows, scenarios, costs), ("file_id", *GROUP))
        (part.repartition("file_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("file_id").parquet(state_path))
    elif not known:
        raise MissingInputError(f"no member files in {member_path}")
    current = spark.read.parquet(state_path).filter(F.col("file_id").isin(sorted(now)))
    return merge_states(current), new


def loyalty_weight_expr(loyalty: float = DEFAULT_LOYALTY) -> Column:
    """1 + |L| * 0.5 * tenure (L >= 0) or 1 - tenure (L < 0).

    At L = 0 the weight is 1 whatever the tenure; a population of one tenure
    counts as tenure 0.
    """
    if float(loyalty) == 0.0:
        return F.lit(1.0)
    tn = F.when(F.col("pop_min_mob") == F.col("pop_max_mob"), F.lit(0.0)).otherwise(
        min_max_scale("Months_on_book", F.col("pop_min_mob"), F.col("pop_max_mob")))
    target = tn if loyalty >= 0 else F.lit(1) - tn
    return F.lit(1.0) + F.lit(abs(float(loyalty))) * F.lit(0.5) * target


def with_population(df: DataFrame, loyalty: float = DEFAULT_LOYALTY, group_cols=GROUP,
                    scalars: DataFrame | None = None) -> DataFrame:
    """Attach the scalars, loyalty weight and normalised value (value / max value).

    ``scalars``: rows of :func:`population_scalars`, if they are known already.
    """
    scal = population_scalars(df, group_cols) if scalars is None else scalars
    return (
        df.join(F.broadcast(scal), list(group_cols))
        .withColumn("Loyalty_Weight", loyalty_weight_expr(loyalty))
        .withColumn("Normalized_Value",
                    F.try_divide(F.col("Total_Account_Value"), F.col("pop_max_value")))
        .drop(*[c for c in scal.columns if c.startswith("pop_")])
    )


def priority_expr(risk_weight) -> Column:
    """(risk * w/100 + normalised value * (100-w)/100) * loyalty; -1 for sleeping dogs.

    ``risk_weight`` is an int (a what-if setting) or an int column (the sweep).
    """
    w = risk_weight if isinstance(risk_weight, Column) else F.lit(int(risk_weight))
    score = ((F.col(RISK) * w / F.lit(100)
              + F.col("Normalized_Value") * (F.lit(100) - w) / F.lit(100))
             * F.col("Loyalty_Weight"))
    return F.when(F.col("Is_Sleeping_Dog"), F.lit(-1.0)).otherwise(score)


def priority(df: DataFrame, risk_weight, col: str = "Priority_Score") -> DataFrame:
    return df.withColumn(col, priority_expr(risk_weight))
