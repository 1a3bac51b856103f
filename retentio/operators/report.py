"""Report tables over one scenario's decisions.

Inputs are decision tables from :func:`retentio.operators.scenarios.scenario_decisions`.
Target lists are top-K rows (a k-row heap per task); profiles are single
aggregates; comparisons over several lists take all lists from one scan and
use one conditional aggregate, never a join of one-row tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retentio.constants import (
    ACTIONS, DEFAULT_CAPACITY, DEFAULT_MANUAL_WEIGHT, FAIRNESS_AGE_GAP, TENURE_BANDS,
)
from retentio.functions.scalar import (
    allocation_text, money_text, months_text, of_capacity_text, pct_text, round_even, tenure_band,
)
from retentio.operators.population import population_state, priority_expr, with_population
from retentio.operators.rank import top_k, top_k_per_group



def priority_order():
    return [F.col("Live_Priority").desc_nulls_last(), F.col("member_key")]

TARGET_VIEW = ("member_key", "Intervention_Type", "Churn_Risk_Score", "Total_Account_Value",
               "Net_ROI", "Segment")


def _weight_col(risk_weight):
    """An int weight, or the ``Optimal_Risk_Weight_Pct`` column of a joined optimum."""
    return F.col(risk_weight) if isinstance(risk_weight, str) else risk_weight


def with_optimum(dec: DataFrame, best: DataFrame) -> DataFrame:
    """Attach the per-scenario optimum (one row per scenario: bounded broadcast)."""
    return dec.join(F.broadcast(best.select("Scenario", "Optimal_Risk_Weight_Pct")), "Scenario")


def target_list(dec: DataFrame, risk_weight, capacity: int = DEFAULT_CAPACITY) -> DataFrame:
    """The ``capacity`` members with the highest priority at ``risk_weight``.

    ``risk_weight`` is an int or a column name (e.g. the optimum joined on).
    Ties are broken by member key, so the list is repeatable.
    """
    scored = dec.withColumn("Live_Priority", priority_expr(_weight_col(risk_weight)))
    return top_k(scored.filter(F.col("Live_Priority").isNotNull()), priority_order(), capacity).withColumn(
        "Intervention_Type", F.col("Recommended_Action"))


def target_view(tl: DataFrame) -> DataFrame:
    """P10: the columns the dashboard table shows."""
    return tl.select(*TARGET_VIEW)


def action_mix(tl: DataFrame) -> DataFrame:
    """Members per action, biggest first, then by name."""
    return (tl.groupBy(F.col("Recommended_Action").alias("Intervention"))
            .agg(F.count("*").cast("long").alias("Count"))
            .orderBy(F.col("Count").desc(), F.col("Intervention")))


def tier_mix(tl: DataFrame) -> DataFrame:
    """Members per card tier, biggest first, then by name."""
    return (tl.groupBy(F.col("Segment"))
            .agg(F.count("*").cast("long").alias("Count"))
            .orderBy(F.col("Count").desc(), F.col("Segment")))


def band_table(spark: SparkSession) -> DataFrame:
    """The four tenure bands, in order (a fixed 4-row dimension)."""
    rows = F.array(*[F.struct(F.lit(i).alias("Band_Order"), F.lit(label).alias("Tenure_Band"))
                     for i, (_, _, label) in enumerate(TENURE_BANDS)])
    return spark.range(1).select(F.inline(rows))


def tenure_mix(tl: DataFrame) -> DataFrame:
    """A10: members per tenure band; empty bands kept as 0, rows outside all bands left out."""
    counts = (tl.select(tenure_band("Months_on_book").alias("Tenure_Band"))
              .groupBy("Tenure_Band").agg(F.count("*").alias("n")))
    # both sides have at most one row per band
    return (band_table(tl.sparkSession).join(F.broadcast(counts), "Tenure_Band", "left")
            .select("Tenure_Band", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("Count"),
                    "Band_Order")
            .orderBy("Band_Order").drop("Band_Order"))


def target_kpis(tl: DataFrame) -> DataFrame:
    """A12/A13 (D14 KPIs): size, ROI, means of risk/tenure/value/age, high-touch calls."""
    return tl.agg(
        F.count("*").cast("long").alias("Target_List_Size"),
        round_even(F.sum(F.col("Net_ROI").cast("decimal(38,8)")).cast("double"), 4).alias("Total_Net_ROI"),
        round_even(F.avg("Churn_Risk_Score"), 6).alias("Avg_Churn_Risk"),
        round_even(F.avg("Months_on_book"), 6).alias("Avg_Tenure_Months"),
        round_even(F.avg("Total_Account_Value"), 4).alias("Avg_Account_Value"),
        round_even(F.avg("Customer_Age"), 6).alias("Avg_Age"),
        F.count_if(F.col("Recommended_Action").contains("Call")).cast("long").alias("High_Touch_Calls"),
    )


def population_mean_age(dec: DataFrame) -> DataFrame:
    """A14."""
    return dec.agg(round_even(F.avg("Customer_Age"), 6).alias("Population_Mean_Age"))


def strategy_lists(dec: DataFrame, best: DataFrame, manual_weight: int = DEFAULT_MANUAL_WEIGHT,
                   capacity: int = DEFAULT_CAPACITY, columns=("Net_ROI", "Customer_Age")) -> DataFrame:
    """The target lists of the optimum and of a manual weight, from one scan of the decisions.

    Every row is scored for both strategies, and a top-K per strategy keeps
    ``capacity`` rows of each (each task ships at most that many).  Returns
    ``Strategy``, ``Risk_Weight_Pct``, ``Live_Priority`` and ``columns``.
    """
    weights = F.array(
        F.struct(F.lit("optimal").alias("Strategy"), F.col("Optimal_Risk_Weight_Pct").cast("int").alias("Risk_Weight_Pct")),
        F.struct(F.lit("manual").alias("Strategy"), F.lit(int(manual_weight)).alias("Risk_Weight_Pct")))
    scored = with_optimum(dec, best).select("*", F.inline(weights)).withColumn(
        "Live_Priority", priority_expr(F.col("Risk_Weight_Pct")))
    scored = scored.filter(F.col("Live_Priority").isNotNull()).select(
        "Strategy", "Risk_Weight_Pct", "Live_Priority", "member_key", *[c for c in columns if c != "member_key"])
    top = top_k_per_group(scored, ["Strategy"], priority_order(), capacity)
    return top.select("Strategy", "Risk_Weight_Pct", "Live_Priority", *columns)


def compare_strategies(dec: DataFrame, best: DataFrame, manual_weight: int = DEFAULT_MANUAL_WEIGHT,
                       capacity: int = DEFAULT_CAPACITY, lists: DataFrame | None = None) -> DataFrame:
    """ROI captured by the optimum and by a manual weight, and the difference.

    ``lists``: rows of ``strategy_lists``, if the two lists are there already.
    """
    lists = strategy_lists(dec, best, manual_weight, capacity) if lists is None else lists
    roi = F.col("Net_ROI").cast("decimal(38,8)")
    agg = lists.agg(
        F.max(F.when(F.col("Strategy") == "optimal", F.col("Risk_Weight_Pct"))).alias("Optimal_Risk_Weight_Pct"),
        F.max(F.when(F.col("Strategy") == "manual", F.col("Risk_Weight_Pct"))).alias("Manual_Risk_Weight_Pct"),
        F.sum(F.when(F.col("Strategy") == "optimal", roi)).cast("double").alias("_opt"),
        F.sum(F.when(F.col("Strategy") == "manual", roi)).cast("double").alias("_man"),
    )
    return agg.select(
        "Optimal_Risk_Weight_Pct", "Manual_Risk_Weight_Pct",
        round_even("_opt", 4).alias("Optimal_Net_ROI"),
        round_even("_man", 4).alias("Manual_Net_ROI"),
        round_even(F.col("_man") - F.col("_opt"), 4).alias("Delta_vs_Optimum"),
        money_text(F.col("_opt")).alias("Optimal_Net_ROI_Text"),
    )


def strategy_text(comparison: DataFrame) -> DataFrame:
    """the comparison row as the dashboard prints it: allocations, sums and the difference."""
    return comparison.select(
        allocation_text("Optimal_Risk_Weight_Pct").alias("Optimal_Allocation"),
        allocation_text("Manual_Risk_Weight_Pct").alias("Manual_Allocation"),
        money_text("Optimal_Net_ROI").alias("Optimal_Net_ROI_Text"),
        money_text("Manual_Net_ROI").alias("Manual_Net_ROI_Text"),
        F.concat(money_text("Delta_vs_Optimum"), F.lit(" vs optimum")).alias("Delta_Text"))


def fairness_check(dec: DataFrame, best: DataFrame, manual_weight: int = DEFAULT_MANUAL_WEIGHT,
                   capacity: int = DEFAULT_CAPACITY, max_gap: float = FAIRNESS_AGE_GAP,
                   lists: DataFrame | None = None, population: DataFrame | None = None) -> DataFrame:
    """Mean age of each target list against the population; alert above ``max_gap``.

    ``population``: rows with ``pop_n_age`` and ``pop_age`` (members with an
    age, and their ages' sum), such as a stored ``population_state``; else the
    decisions are read once more.
    """
    lists = strategy_lists(dec, best, manual_weight, capacity) if lists is None else lists
    if population is None:
        population = dec.agg(F.count("Customer_Age").alias("pop_n_age"), F.sum("Customer_Age").alias("pop_age"))
    # one row of sums beside the aggregate of the lists
    ages = population.agg(F.try_divide(F.sum("pop_age"), F.sum("pop_n_age"))).scalar()

    def avg_of(tag):
        return F.avg(F.when(F.col("Strategy") == tag, F.col("Customer_Age")))

    def weight_of(tag):
        return F.max(F.when(F.col("Strategy") == tag, F.col("Risk_Weight_Pct")))

    one = lists.agg(avg_of("optimal").alias("opt"), weight_of("optimal").alias("w_opt"),
                    avg_of("manual").alias("man"), weight_of("manual").alias("w_man")).withColumn("pop", ages)
    rows = F.array(
        F.struct(F.lit("optimal").alias("Strategy"), F.col("w_opt").alias("Risk_Weight_Pct"),
                 F.col("opt").alias("t"), F.col("pop").alias("p")),
        F.struct(F.lit("manual").alias("Strategy"), F.col("w_man").alias("Risk_Weight_Pct"),
                 F.col("man").alias("t"), F.col("pop").alias("p")))
    gap = F.abs(F.col("p") - F.col("t"))
    return one.select(F.inline(rows)).select(
        "Strategy", "Risk_Weight_Pct",
        round_even("t", 6).alias("Target_Mean_Age"),
        round_even("p", 6).alias("Population_Mean_Age"),
        round_even(gap, 6).alias("Age_Gap"),
        (gap > F.lit(float(max_gap))).alias("Compliance_Alert"))


def expected_loss_priority(scored: DataFrame, how: str = "none") -> DataFrame:
    """Expected_Loss = risk * spend; Priority_Score = 0-100 scale of it, 1 place.

    The maximum is a scalar subquery: one partial max per task, one value back.
    The input is read twice (maximum, then rows); shuffle stages below it are
    shared, but a costly projection (model scoring) is not, so pass
    ``how=None`` (the session default) to materialise such an input once.
    """
    from retentio.session import materialize
    scored = materialize(scored, how)
    el = F.col("Churn_Risk_Score") * F.col("Total_Trans_Amt")
    with_el = scored.withColumn("Expected_Loss", el)
    mx = with_el.select(F.max("Expected_Loss")).scalar()
    return with_el.withColumn(
        "Priority_Score", round_even(F.try_divide(F.col("Expected_Loss"), mx) * F.lit(100), 1))


def target_profile(tl: DataFrame) -> dict[str, DataFrame]:
    """Who is on the list - KPIs (one row), by card tier, by tenure band."""
    return {"kpis": target_kpis(tl), "by_tier": tier_mix(tl), "by_tenure": tenure_mix(tl)}


def profile_table(tl: DataFrame) -> DataFrame:
    """D14 as one table: (Part, Item, Value) of the KPIs, the card tiers and the tenure bands."""
    kpis = target_kpis(tl)
    parts = [kpis.select([F.col(c).cast("double") for c in kpis.columns]).unpivot([], kpis.columns, "Item", "Value")]
    parts += [mix.toDF("Item", "n").select("Item", F.col("n").cast("double").alias("Value"))
              for mix in (tier_mix(tl), tenure_mix(tl))]
    tagged = [p.select(F.lit(name).alias("Part"), "Item", "Value") for name, p in zip(("kpi", "tier", "tenure"), parts)]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


def profile_text(kpis: DataFrame, capacity: int = DEFAULT_CAPACITY) -> DataFrame:
    """the KPI row as the dashboard prints it."""
    return kpis.select(
        pct_text("Avg_Churn_Risk").alias("Avg_Churn_Risk_Text"),
        months_text("Avg_Tenure_Months").alias("Avg_Tenure_Text"),
        money_text("Avg_Account_Value", 0).alias("Avg_Account_Value_Text"),
        money_text("Total_Net_ROI").alias("Total_Net_ROI_Text"),
        of_capacity_text("High_Touch_Calls", capacity).alias("High_Touch_Calls_Text"))


def fairness_text(fairness: DataFrame) -> DataFrame:
    """one sentence for each strategy, mean ages to one place."""
    verdict = F.when(F.col("Compliance_Alert"), F.lit("Age gap too wide")).otherwise(F.lit("Age gap within the limit"))
    return fairness.select("Strategy", F.concat(
        verdict, F.lit(": target list "), F.format_number("Target_Mean_Age", 1),
        F.lit(" years, population "), F.format_number("Population_Mean_Age", 1), F.lit(" years")).alias("Fairness_Text"))


def what_if(members: DataFrame, margin: float = 0.025, costs=None, loyalty: float = 0.0,
            capacity: int = DEFAULT_CAPACITY, manual_weight: int = DEFAULT_MANUAL_WEIGHT,
            how: str | None = None) -> dict[str, DataFrame]:
    """Every dashboard table for one parameter set (costs, margin, loyalty, capacity, manual weight).

    The member table, the curve and the two target lists are stored once; every
    other table is a lazy plan over them (decisions are row-local and
    recomputed by each reader).
    """
    from retentio.operators.decide import Costs, decide_scenarios
    from retentio.operators.sweep import optimal_weight, tradeoff_curve
    from retentio.session import materialize

    costs = costs or Costs()
    base = materialize(members, how)
    decided = decide_scenarios(base, ((f"Margin {margin * 100:g}%", float(margin)),), costs)
    state = materialize(population_state(decided))
    dec = with_population(decided, loyalty, scalars=state)
    # the curve (one row per weight) and the two lists (capacity rows each) are
    # small and read by several tables: stored, so the sweep runs once
    curve = materialize(tradeoff_curve(dec, capacity))
    best = optimal_weight(curve)
    lists = materialize(strategy_lists(dec, best, manual_weight, capacity, dec.columns)
                        .withColumn("Intervention_Type", F.col("Recommended_Action")))
    opt, man = (lists.filter(F.col("Strategy") == s) for s in ("optimal", "manual"))
    comparison = compare_strategies(dec, best, manual_weight, capacity, lists)
    return {
        "decisions": dec,
        "curve": curve,
        "optimum": best,
        "optimal_list": target_view(opt),
        "manual_list": target_view(man),
        "comparison": comparison,
        "comparison_text": strategy_text(comparison),
        "fairness": fairness_check(dec, best, manual_weight, capacity, lists=lists, population=state),
        "optimal_mix": action_mix(opt),
        "manual_mix": action_mix(man),
        **{f"profile_{k}": v for k, v in target_profile(opt).items()},
    }
