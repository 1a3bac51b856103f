"""Multi-scenario scoring (D15) and its summary.

One plan for all margin scenarios: the scenario list is expanded per member
(no join), population scalars come from one aggregate per scenario, and the
rank runs distributed (see rank.py).  Building it writes two tables, the
members and the rows to rank (scenario, priority, key); the sweep's optimum
is small and recomputed by its readers.  Members without a score are ranked
last and are in no target list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentio.constants import (
    ACTIONS, DEFAULT_CAPACITY, DEFAULT_LOYALTY, SCENARIO_COLUMNS, SCENARIOS, WEIGHT_STEP,
)
from retentio.functions.scalar import allocation_text, member_id, percent, round_even, tenure_band
from retentio.operators.decide import Costs, decide_scenarios
from retentio.operators.population import population_scalars, priority_expr, with_population
from retentio.operators.rank import counted_rank, top_k_per_group
from retentio.operators.sweep import optimal_weight, tradeoff_curve
from retentio.session import materialize


def scenario_decisions(members: DataFrame, scenarios=SCENARIOS, costs: Costs = Costs(),
                       loyalty: float = DEFAULT_LOYALTY, effectiveness=None) -> DataFrame:
    """Decisions, loyalty weight and normalised value for every member and scenario."""
    return with_population(decide_scenarios(members, scenarios, costs, effectiveness), loyalty)


def score_scenarios(members: DataFrame, scenarios=SCENARIOS, capacity: int = DEFAULT_CAPACITY,
                    costs: Costs = Costs(), loyalty: float = DEFAULT_LOYALTY,
                    step: int = WEIGHT_STEP, how: str | None = None,
                    full: bool = False) -> DataFrame:
    """The tidy scenario table (23 columns; ``full`` keeps all helper columns).

    The member table is materialised once (the population aggregate, the
    sweep and the rank read it); the decisions on top of it are row-local
    projections, recomputed by each reader instead of stored.  Ranks are made
    on (scenario, priority, key) alone and joined back by key, once a member
    and before the scenarios are expanded.  ``member_key`` must be unique; a
    repeated one raises an error.
    """
    members = materialize(members, how)
    scored, best, scalars = _scored(members, scenarios, capacity, costs, loyalty, step)
    narrow = materialize(scored.select("Scenario", "member_key", "Priority_Score"), how)
    ranks = counted_rank(narrow, "Priority_Score", "member_key", rank_col="Priority_Rank")
    n = len(scenarios)
    by_member = ranks.groupBy("member_key").agg(
        F.collect_list(F.struct("Scenario", "Priority_Rank")).alias("_ranks")).select(
        F.col("member_key").alias("_key"), F.when(F.size("_ranks") == n, F.map_from_entries("_ranks")).otherwise(
            F.raise_error(F.concat(F.lit("member_key is not unique: "), F.coalesce(F.col("member_key").cast("string"), F.lit("null")))))
        .alias("_ranks"))
    ranked = members.join(by_member, F.col("member_key").eqNullSafe(F.col("_key"))).drop("_key")
    table = _at_optimum(with_population(decide_scenarios(ranked, scenarios, costs), loyalty, scalars=scalars), best)
    table = table.withColumn("Priority_Rank", F.element_at("_ranks", F.col("Scenario"))).drop("_ranks")
    return _finish(table if full else table.select(*_NEEDED, "Priority_Rank"), capacity, full)


def _at_optimum(dec: DataFrame, best: DataFrame) -> DataFrame:
    # one row per scenario of the parameter list: bounded broadcast
    return (dec.join(F.broadcast(best.select("Scenario", "Optimal_Risk_Weight_Pct")), "Scenario")
            .withColumn("Priority_Score", priority_expr(F.col("Optimal_Risk_Weight_Pct"))))


def _scored(members: DataFrame, scenarios, capacity: int, costs: Costs, loyalty: float,
            step: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Decisions at the optimum, the optimum and the population's scalars, over a stored member table."""
    decided = decide_scenarios(members, scenarios, costs)
    # a row a scenario each, read by several steps: stored
    scalars = materialize(population_scalars(decided))
    dec = with_population(decided, loyalty, scalars=scalars)
    best = materialize(optimal_weight(tradeoff_curve(dec, capacity, step)))
    return _at_optimum(dec, best), best, scalars


def scored_at_optimum(members: DataFrame, scenarios=SCENARIOS, capacity: int = DEFAULT_CAPACITY,
                      costs: Costs = Costs(), loyalty: float = DEFAULT_LOYALTY, step: int = WEIGHT_STEP,
                      how: str | None = None) -> DataFrame:
    """Every member and scenario with the scenario's best weight and the priority at it."""
    return _scored(materialize(members, how), scenarios, capacity, costs, loyalty, step)[0]


def scenario_targets(members: DataFrame, scenarios=SCENARIOS, capacity: int = DEFAULT_CAPACITY) -> DataFrame:
    """The target rows of the scenario table, by a top-K per scenario and no global rank."""
    scored = scored_at_optimum(members, scenarios, capacity).select(*_NEEDED)
    top = top_k_per_group(scored.filter(F.col("Priority_Score").isNotNull()), ["Scenario"], rank_order(), capacity,
                          rank_col="Priority_Rank")
    return _finish(top, capacity)


def target_flags(members: DataFrame, scenarios=SCENARIOS, capacity: int = DEFAULT_CAPACITY) -> DataFrame:
    """Every member and scenario with ``In_Target_List``: at or before the last target's (priority, key)."""
    scored = scored_at_optimum(members, scenarios, capacity).select("Scenario", "member_key", "Priority_Score")
    top = top_k_per_group(scored.filter(F.col("Priority_Score").isNotNull()), ["Scenario"], rank_order(), capacity)
    # one row per scenario of the parameter list: bounded broadcast
    last = top.groupBy("Scenario").agg(F.max_by(F.struct("Priority_Score", "member_key"), "rn").alias("last"))
    p, lp, lk = F.col("Priority_Score"), F.col("last")["Priority_Score"], F.col("last")["member_key"]
    inside = (p > lp) | ((p == lp) & (F.col("member_key") <= lk))
    return scored.join(F.broadcast(last), "Scenario", "left").select(
        member_id("member_key").alias("Customer_ID"), "Scenario",
        F.coalesce(inside, F.lit(False)).alias("In_Target_List"))


def rank_order():
    return [F.col("Priority_Score").desc_nulls_last(), F.col("member_key")]


def _finish(ranked: DataFrame, capacity: int, full: bool = False) -> DataFrame:
    """Columns of the scenario table from ranked rows."""
    out = (ranked
           .withColumn("In_Target_List", (F.col("Priority_Rank") <= F.lit(int(capacity)))
                       & F.col("Priority_Score").isNotNull())
           .withColumn("Priority_Rank", F.col("Priority_Rank").cast("long"))
           .withColumn("Scenario_Interchange_Pct", percent("margin"))
           .withColumn("Recommended_Allocation", allocation_text("Optimal_Risk_Weight_Pct"))
           .withColumn("Customer_ID", member_id("member_key"))
           .withColumn("Card_Tier", F.col("Card_Category"))
           .withColumn("Tenure_Band", tenure_band("Months_on_book"))
           .withColumn("Churn_Risk_Pct", percent("Churn_Risk_Score", 1)))
    if full:
        return out
    rounded = {c: round_even(c, 2).alias(c)
               for c in ("Total_Account_Value", "Value_At_Stake", "Net_ROI", "Save_Prob")}
    return out.select(*[rounded.get(c, F.col(c)) for c in SCENARIO_COLUMNS])


# columns the 23-column table is built from (the rank materialises only these)
_NEEDED = ("Scenario", "margin", "Optimal_Risk_Weight_Pct", "member_key", "Recommended_Action",
           "Priority_Score", "Churn_Risk_Score", "Total_Account_Value", "Value_At_Stake", "Net_ROI",
           "Save_Prob", "Is_Sleeping_Dog", "Card_Category", "Customer_Age", "Months_on_book",
           "Total_Relationship_Count", "Total_Trans_Amt", "Total_Trans_Ct", "Months_Inactive_12_mon")


def scenario_summary(table: DataFrame) -> DataFrame:
    """Per scenario - best weight, target-list ROI and counts by action."""
    tl = table.filter(F.col("In_Target_List"))
    counts = [F.count_if(F.col("Recommended_Action") == F.lit(a)).cast("long").alias(f"n_{i}")
              for i, a in enumerate(ACTIONS)]
    return tl.groupBy("Scenario").agg(
        F.max("Optimal_Risk_Weight_Pct").alias("Optimal_Risk_Weight_Pct"),
        F.sum(F.col("Net_ROI").cast("decimal(38,2)")).cast("double").alias("Target_List_ROI"),
        F.count("*").cast("long").alias("Target_List_Size"),
        *counts,
    ).withColumnsRenamed({f"n_{i}": n for i, n in enumerate(
        ("n_email", "n_rep_call", "n_senior_call", "n_sleeping_dog"))})


def action_counts(table: DataFrame) -> DataFrame:
    """Target rows by scenario and action, (Scenario, Recommended_Action, Members)."""
    return (table.filter(F.col("In_Target_List")).groupBy("Scenario", "Recommended_Action")
            .agg(F.count("*").cast("long").alias("Members")))


def action_maps(table: DataFrame) -> DataFrame:
    """A11 in map form: one row a scenario with its actions and counts, at most one entry an action."""
    pairs = F.array_sort(F.collect_list(F.struct("Recommended_Action", "Members")))
    return action_counts(table).groupBy("Scenario").agg(F.map_from_entries(pairs).alias("Actions"))


def export_scenarios(members: DataFrame, path: str, scenarios=SCENARIOS, capacity: int = DEFAULT_CAPACITY,
                     costs: Costs = Costs(), loyalty: float = DEFAULT_LOYALTY, fmt: str = "csv") -> DataFrame:
    """Score every scenario, write the tidy table (one folder per scenario) and
    return the per-scenario summary, read back from what was written."""
    from retentio.sources.files import write_scenarios
    table = score_scenarios(members, scenarios, capacity, costs, loyalty)
    write_scenarios(table, path, fmt=fmt)
    spark = members.sparkSession
    if fmt == "csv":
        return scenario_summary(spark.read.option("header", True).schema(table.schema).csv(path))
    return scenario_summary(spark.read.format(fmt).load(path))
