"""Registered queries: one per operator id, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the order tables through the member source, so its work
grows with the data.  Decision queries use the deterministic rule risk so
that each has an exact SQL oracle (see oracle.py); model queries use the
learned risk and are checked by bounds and row counts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retentio.constants import (
    DEFAULT_CAPACITY, DEFAULT_MANUAL_WEIGHT, FEATURES, SCENARIOS,
)
from retentio.functions.scalar import (
    allocation_text, clip, member_id, min_max_scale, money_text, percent, round_even, tenure_band,
)
from retentio.operators import forest, learn, report, tree
from retentio.operators.brief import brief, importance_chart
from retentio.operators.decide import best_channel, decide, decide_scenarios, with_scenarios
from retentio.operators.population import (
    loyalty_weight_expr, population_scalars, population_state, priority_expr, with_population,
)
from retentio.operators.scenarios import (
    action_counts, scenario_decisions, scenario_summary, scenario_targets, score_scenarios, scored_at_optimum, target_flags,
)
from retentio.operators.sweep import (
    optimal_weight, pruned_priorities, top_rows, tradeoff_curve, weight_priorities, with_objective,
)
from retentio.session import materialize
from retentio.sources.members import drop_unused, member_table

BASE = (SCENARIOS[1],)
K = DEFAULT_CAPACITY
MANUAL_W = DEFAULT_MANUAL_WEIGHT

Query = Callable[[SparkSession, str], DataFrame]


# ---- shared inputs -----------------------------------------------------------

def members(spark, sf):
    return member_table(spark, sf)


def _members_for(spark, sf, how: str):
    return materialize(members(spark, sf), how)


def base_decisions(spark, sf):
    """Base-margin decisions: row-local columns only, so one pass over the orders."""
    return decide_scenarios(members(spark, sf), BASE)


def all_decisions(spark, sf):
    return decide_scenarios(members(spark, sf), SCENARIOS)


def scored_decisions(spark, sf, scenarios=BASE, how: str | None = "none"):
    """Decisions with the population's scalars (loyalty weight, normalised value)."""
    return scenario_decisions(_members_for(spark, sf, how), scenarios)


def _base_report(spark, sf):
    """Base-margin decisions over a materialised member table (the sweep and the lists both read it)."""
    dec, best, _ = _base_state(spark, sf)
    return dec, best


def _base_state(spark, sf):
    """(decisions, optimum, population's state); the last two hold a row a scenario and are stored."""
    decided = decide_scenarios(_members_for(spark, sf, None), BASE)
    state = materialize(population_state(decided))
    dec = with_population(decided, scalars=state)
    return dec, materialize(optimal_weight(tradeoff_curve(dec, K))), state


def _optimal_list(spark, sf):
    dec, best = _base_report(spark, sf)
    return report.target_list(report.with_optimum(dec, best), "Optimal_Risk_Weight_Pct", K)


def _scenario_table(spark, sf, full: bool = False):
    return score_scenarios(members(spark, sf), SCENARIOS, K, full=full)


def rule_prediction():
    return F.when(F.col("Churn_Risk_Score") > F.lit(0.5), F.lit(1.0)).otherwise(F.lit(0.0))


# ---- 2.1 sources -----------------------------------------------------------

def s8_preview(spark, sf):
    return (members(spark, sf)
            .select("member_key", "Customer_Age", "Total_Trans_Ct", "Churn_Flag", "Card_Category")
            .orderBy("member_key").limit(5))


# ---- 2.2 projections -------------------------------------------------------

def p1_drop_columns(spark, sf):
    raw = (member_table(spark, sf, with_risk=False).drop("Churn_Flag")
           .withColumnRenamed("member_key", "CLIENTNUM"))
    return drop_unused(raw)


def p2_churn_label(spark, sf):
    return members(spark, sf).select("member_key", "Attrition_Flag", "Churn_Flag")


def p3_scored_columns(spark, sf):
    return members(spark, sf).select("member_key", *FEATURES, "Card_Category", "Churn_Flag",
                                     rule_prediction().alias("prediction"), "Churn_Risk_Score")


def p6_scenario_constants(spark, sf):
    margin = F.element_at(F.create_map(*[F.lit(x) for pair in SCENARIOS for x in pair]), F.col("Scenario"))
    best = optimal_weight(d9_tradeoff_curve(spark, sf)).withColumn("margin", margin)
    return best.select("Scenario", percent("margin").alias("Scenario_Interchange_Pct"), "Optimal_Risk_Weight_Pct")


def p7_allocation_text(spark, sf):
    best = optimal_weight(d9_tradeoff_curve(spark, sf))
    return best.select("Scenario", allocation_text("Optimal_Risk_Weight_Pct").alias("Recommended_Allocation"))


def p8_tier_alias(spark, sf):
    return members(spark, sf).select("member_key", F.col("Card_Category").alias("Card_Tier"),
                                     F.col("Card_Category").alias("Segment"))


def p9_member_id(spark, sf):
    return members(spark, sf).select("member_key", member_id("member_key").alias("Customer_ID"))


def p10_target_view(spark, sf):
    return report.target_view(_optimal_list(spark, sf))


# ---- 2.3 filters -----------------------------------------------------------

def b1_churned(spark, sf):
    return members(spark, sf).filter(F.col("Churn_Flag") == 1).select("member_key", "Attrition_Flag")


def b2_true_positives(spark, sf):
    m = members(spark, sf).withColumn("prediction", rule_prediction())
    return (m.filter((F.col("Churn_Flag") == 1) & (F.col("prediction") == 1.0))
            .select("member_key", "Churn_Flag", "prediction"))


def b3_sleeping_dogs(spark, sf):
    return (base_decisions(spark, sf).filter(F.col("Is_Sleeping_Dog"))
            .select("member_key", "Churn_Risk_Score", "Months_Inactive_12_mon", "Total_Ct_Chng_Q4_Q1"))


def b4_at_risk(spark, sf):
    return members(spark, sf).select("member_key", (F.col("Churn_Risk_Score") > F.lit(0.5)).alias("At_Risk"))


def b5_target_rows(spark, sf):
    t = scenario_targets(members(spark, sf), BASE, K)
    return (t.filter(F.col("In_Target_List"))
            .select("Customer_ID", "Recommended_Action", "Net_ROI"))


def b6_call_actions(spark, sf):
    return (_optimal_list(spark, sf).filter(F.col("Intervention_Type").contains("Call"))
            .select("member_key", "Intervention_Type"))


def b7_email_fallback(spark, sf):
    d = base_decisions(spark, sf)
    _, best = best_channel()
    return (d.filter(~F.col("Is_Sleeping_Dog") & (best <= F.lit(0.0)))
            .select("member_key", "Recommended_Action", "Net_ROI", "ROI_Email"))


def b8_dog_override(spark, sf):
    return (base_decisions(spark, sf).filter(F.col("Is_Sleeping_Dog"))
            .select("member_key", "Recommended_Action", "Net_ROI", "Expected_Value_Saved"))


# ---- 2.4 joins -------------------------------------------------------------

def j1_member_scenarios(spark, sf):
    d = decide(with_scenarios(members(spark, sf), SCENARIOS), F.col("margin"))
    return d.select("member_key", "Scenario", "margin", "Total_Account_Value")


def j2_member_weights(spark, sf):
    d = scored_decisions(spark, sf)
    return weight_priorities(d, ["Scenario"], 2).select("member_key", F.col("w").alias("Risk_Weight_Pct"),
                                              F.col("p").alias("Priority_Score"))


def j3_population_scalars(spark, sf):
    return scored_decisions(spark, sf).select("member_key", "Normalized_Value", "Loyalty_Weight")


def j4_best_weight(spark, sf):
    return scored_at_optimum(members(spark, sf), SCENARIOS, K).select("member_key", "Scenario", "Optimal_Risk_Weight_Pct", "Priority_Score")


# ---- 2.5 aggregates --------------------------------------------------------

def a1_row_count(spark, sf):
    return members(spark, sf).agg(F.count("*").cast("long").alias("members"))


def a2_churn_rate(spark, sf):
    return members(spark, sf).agg(round_even(F.avg("Churn_Flag"), 6).alias("churn_rate"))


def a3_class_weights(spark, sf):
    w = learn.class_weights(members(spark, sf))
    return w.select("n", "pos", round_even("w_pos", 6).alias("w_pos"), round_even("w_neg", 6).alias("w_neg"))


def _rule_test_predictions(spark, sf):
    m = members(spark, sf).withColumn("prediction", rule_prediction())
    return m.filter(learn.test_flag())


def a4_confusion(spark, sf):
    return learn.confusion(_rule_test_predictions(spark, sf)).select("tp", "fp", "fn", "tn", "test_set_size")


def a5_precision_recall(spark, sf):
    c = learn.confusion(_rule_test_predictions(spark, sf))
    return c.select(round_even("precision", 6).alias("precision"), round_even("recall", 6).alias("recall"),
                    round_even("churn_f1", 6).alias("churn_f1"))


def a6_population_minmax(spark, sf):
    d = decide(with_scenarios(members(spark, sf), SCENARIOS), F.col("margin"))
    return population_scalars(d)


def a7_max_expected_loss(spark, sf):
    m = members(spark, sf)
    return m.agg(F.max(F.col("Churn_Risk_Score") * F.col("Total_Trans_Amt")).alias("max_expected_loss"))


def a8_action_mix(spark, sf):
    return report.action_mix(_optimal_list(spark, sf))


def a9_tier_mix(spark, sf):
    return report.tier_mix(_optimal_list(spark, sf))


def a10_tenure_mix(spark, sf):
    return report.tenure_mix(_optimal_list(spark, sf))


def a11_scenario_summary(spark, sf):
    return scenario_summary(scenario_targets(members(spark, sf), SCENARIOS, K))


def a12_target_kpis(spark, sf):
    return report.target_kpis(_optimal_list(spark, sf))


def a13_high_touch(spark, sf):
    return report.target_kpis(_optimal_list(spark, sf)).select("Target_List_Size", "High_Touch_Calls")


def a14_population_age(spark, sf):
    return report.population_mean_age(base_decisions(spark, sf))


def d9_tradeoff_curve(spark, sf):
    return tradeoff_curve(scored_decisions(spark, sf, SCENARIOS, None), K)


def a16_objective(spark, sf):
    c = with_objective(d9_tradeoff_curve(spark, sf))
    return c.withColumn("Objective", round_even("Objective", 9))


def d10_optimal_weight(spark, sf):
    b = optimal_weight(d9_tradeoff_curve(spark, sf))
    return b.withColumn("Best_Objective", round_even("Best_Objective", 9))


# ---- 2.6 ranking -----------------------------------------------------------

def w1_global_rank(spark, sf):
    return _scenario_table(spark, sf).select("Customer_ID", "Scenario", "Priority_Rank")


def w2_top_k_per_weight(spark, sf):
    d = scored_decisions(spark, sf, SCENARIOS, None)
    top = top_rows(pruned_priorities(d, K), K, ["Scenario"])
    return top.select("Scenario", F.col("w").alias("Risk_Weight_Pct"), "member_key",
                      F.col("rn").cast("int").alias("Position"))


def d11_target_list(spark, sf):
    return _optimal_list(spark, sf).select("member_key", "Live_Priority", "Intervention_Type", "Net_ROI",
                                          "Customer_Age")


def w4_target_flag(spark, sf):
    return target_flags(members(spark, sf), SCENARIOS, K)


def d16_expected_loss_priority(spark, sf):
    return report.expected_loss_priority(members(spark, sf)).select(
        "member_key", "Expected_Loss", "Priority_Score")


def w5_full_sort(spark, sf):
    return d16_expected_loss_priority(spark, sf).orderBy(
        F.col("Priority_Score").desc_nulls_last(), F.col("member_key"))


def w8_best_channel(spark, sf):
    argmax, best = best_channel()
    return base_decisions(spark, sf).select("member_key", argmax.alias("Best_Channel"),
                                            best.alias("Best_Channel_ROI"))


# ---- 2.7 set operations ----------------------------------------------------

def u1_union_scenarios(spark, sf):
    m = members(spark, sf)
    parts = [decide(m, margin).withColumn("Scenario", F.lit(name)) for name, margin in SCENARIOS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("member_key", "Scenario", "Recommended_Action", "Net_ROI")


# ---- 2.8 scalar functions --------------------------------------------------

def f1_clip(spark, sf):
    return base_decisions(spark, sf).select("member_key", "Expected_Retention_Years", "Save_Prob",
                                            clip("Total_Ct_Chng_Q4_Q1", 0.1, 1.0).alias("Responsive"))


def f2_arithmetic(spark, sf):
    return base_decisions(spark, sf).select("member_key", "Annual_Margin", "CLV", "Relationship_Multiplier")


def f4_round_even(spark, sf):
    d = all_decisions(spark, sf)
    return d.select("member_key", "Scenario",
                    *[round_even(c, 2).alias(c) for c in
                      ("Total_Account_Value", "Value_At_Stake", "Net_ROI", "Save_Prob")])


def f6_percent(spark, sf):
    d = all_decisions(spark, sf)
    return d.select("member_key", "Scenario", percent("Churn_Risk_Score", 1).alias("Churn_Risk_Pct"),
                    percent("margin").alias("Scenario_Interchange_Pct"))


def f7_tenure_band(spark, sf):
    return members(spark, sf).select("member_key", "Months_on_book",
                                     tenure_band("Months_on_book").alias("Tenure_Band"))


def f8_band_counts(spark, sf):
    return (members(spark, sf).groupBy(tenure_band("Months_on_book").alias("Tenure_Band"))
            .agg(F.count("*").cast("long").alias("Count")))


def f10_money_text(spark, sf):
    tl = _optimal_list(spark, sf)
    s = tl.groupBy("Intervention_Type").agg(F.sum(F.col("Net_ROI").cast("decimal(38,2)")).alias("roi"))
    return s.select("Intervention_Type", money_text(F.col("roi").cast("double")).alias("Net_ROI_Text"))


def f10_profile_text(spark, sf):
    return report.profile_text(report.target_kpis(_optimal_list(spark, sf)), K)


def f10_fairness_text(spark, sf):
    return report.fairness_text(d13_fairness_check(spark, sf))


def f12_min_max_scale(spark, sf):
    d = decide(with_scenarios(members(spark, sf), BASE), F.col("margin"))
    scal = population_scalars(d)
    j = d.join(F.broadcast(scal), "Scenario")
    return j.select("member_key",
                    min_max_scale("Months_on_book", F.col("pop_min_mob"), F.col("pop_max_mob")).alias("Tenure_Norm"),
                    F.try_divide(F.col("Total_Account_Value"), F.col("pop_max_value")).alias("Normalized_Value"))


def f13_loyalty_direction(spark, sf):
    d = decide(with_scenarios(members(spark, sf), BASE), F.col("margin"))
    j = d.join(F.broadcast(population_scalars(d)), "Scenario")
    return j.select("member_key", loyalty_weight_expr(0.5).alias("Protect_Loyal_Weight"),
                    loyalty_weight_expr(-0.5).alias("Rescue_New_Weight"))


# ---- 2.9 decision operators ------------------------------------------------

def d1_account_value(spark, sf):
    return base_decisions(spark, sf).select("member_key", "Expected_Retention_Years", "Annual_Margin", "CLV",
                                            "Relationship_Multiplier", "Total_Account_Value")


def d2_save_probability(spark, sf):
    return base_decisions(spark, sf).select("member_key", "Save_Prob")


def d3_sleeping_dogs(spark, sf):
    return base_decisions(spark, sf).select("member_key", "Is_Sleeping_Dog")


def d4_channel_roi(spark, sf):
    return base_decisions(spark, sf).select("member_key", "Value_At_Stake", "ROI_Email", "ROI_Rep", "ROI_Senior")


def d5_best_action(spark, sf):
    return base_decisions(spark, sf).select("member_key", "Recommended_Action", "Net_ROI")


def d5_action_summary(spark, sf):
    """Flagship: members and summed net ROI per recommended action (base margin)."""
    d = base_decisions(spark, sf)
    return (d.groupBy("Recommended_Action")
            .agg(F.count("*").cast("long").alias("Members"),
                 F.sum(F.col("Net_ROI").cast("decimal(38,8)")).alias("_roi"))
            .select("Recommended_Action", "Members",
                    round_even(F.col("_roi").cast("double"), 2).alias("Net_ROI_Sum")))


def d6_expected_value_saved(spark, sf):
    return base_decisions(spark, sf).select("member_key", "Expected_Value_Saved")


def d7_loyalty_weight(spark, sf):
    m = members(spark, sf)
    return scenario_decisions(m, BASE, loyalty=0.5).select("member_key", "Loyalty_Weight")


def d8_priority(spark, sf):
    return scored_decisions(spark, sf).select("member_key", priority_expr(MANUAL_W).alias("Priority_Score"))


def d12_compare_strategies(spark, sf):
    dec, best = _base_report(spark, sf)
    return report.compare_strategies(dec, best, MANUAL_W, K)


def d13_fairness_check(spark, sf):
    dec, best, state = _base_state(spark, sf)
    return report.fairness_check(dec, best, MANUAL_W, K, population=state)


def f10_strategy_text(spark, sf):
    return report.strategy_text(d12_compare_strategies(spark, sf))


def a11_action_counts(spark, sf):
    return action_counts(scenario_targets(members(spark, sf), SCENARIOS, K))


def d14_target_profile(spark, sf):
    # three tables read the list: stored once
    return report.profile_table(materialize(_optimal_list(spark, sf)))


def d15_score_scenarios(spark, sf):
    return _scenario_table(spark, sf)


# ---- 2.10 learning (bounds and row counts) -----------------------------------

_MODELS: dict = {}


def trained(spark, sf) -> learn.TrainedModel:
    """Fit once per session and input folder; later model queries reuse it."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _MODELS:
        m = learn.arranged(_members_for(spark, sf, None))
        _MODELS[key] = (m, learn.train_and_evaluate(m))
    return _MODELS[key][1]


def _trained_members(spark, sf):
    trained(spark, sf)
    return _MODELS[(spark.sparkContext.applicationId, sf)][0]


def l1_index_tier(spark, sf):
    return learn.index_tier(members(spark, sf)).select("member_key", "Card_Category", "Card_Tier_Index")


def l2_assemble(spark, sf):
    values = vector_to_array("features")
    return learn.assemble(members(spark, sf)).select(
        "member_key", *[values[i].alias(f"feature_{i}") for i in range(len(FEATURES))])


def l3_split(spark, sf):
    return members(spark, sf).select("member_key", learn.test_flag().alias("is_test"))


def l4_fit(spark, sf):
    t = trained(spark, sf)
    return t.train.agg(F.count("*").cast("long").alias("train_rows"),
                       F.lit(t.model.getNumTrees).alias("trees"),
                       F.lit(t.model.totalNumNodes).alias("total_nodes"),
                       F.lit(t.model.getOrDefault("maxDepth")).alias("max_depth"))


def l5_score_test(spark, sf):
    t = trained(spark, sf)
    return learn.with_risk(t.predictions).select("member_key", "Churn_Flag", "prediction", "Churn_Risk_Score")


def l6_score_population(spark, sf):
    t = trained(spark, sf)
    return learn.score_population(t.model, _trained_members(spark, sf)).select(
        "member_key", "prediction", "Churn_Risk_Score", "is_train")


_METRICS: dict = {}
_NODES: dict = {}


def _metrics(spark, sf):
    """The metrics row of the fitted model, evaluated once and stored beside it."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _METRICS:
        t = trained(spark, sf)
        # the curve reads its rows twice: the forest scores them once, into three columns
        scored = materialize(t.predictions.select(learn.LABEL, "rawPrediction", "prediction"))
        _METRICS[key] = materialize(learn.metrics_table(scored, t.model))
    return _METRICS[key]


def _rule_scores(spark, sf):
    return learn.with_count_scores(learn.curve_counts(_rule_test_predictions(spark, sf)))


def l7_rule_curve_areas(spark, sf):
    """L7, L8 on the rule risk of the test side, where SQL can check them."""
    return _rule_scores(spark, sf).select(*[round_even(c, 6).alias(c) for c in ("roc_auc", "pr_auc")])


def l9_rule_count_scores(spark, sf):
    """L9, L10 on the rule prediction of the test side, where SQL can check them."""
    return _rule_scores(spark, sf).select(*[round_even(c, 6).alias(c) for c in ("accuracy", "f1")])


def l7_roc_auc(spark, sf):
    return _metrics(spark, sf).select("roc_auc")


def l8_pr_auc(spark, sf):
    return _metrics(spark, sf).select("pr_auc")


def l9_accuracy(spark, sf):
    return _metrics(spark, sf).select("accuracy")


def l10_f1(spark, sf):
    return _metrics(spark, sf).select("f1", "churn_f1")


def l11_importances(spark, sf):
    return learn.importances(trained(spark, sf).model)


def l12_metrics(spark, sf):
    return _metrics(spark, sf)


def l13_scored_export(spark, sf):
    t = trained(spark, sf)
    scored = learn.score_population(t.model, _trained_members(spark, sf))
    # forest scoring is a projection: materialise it rather than score twice
    return report.expected_loss_priority(scored, how=None)


def d15_score_scenarios_learned(spark, sf):
    """The scenario table on the model's risk: scored members feed the same
    decision, sweep and rank operators (risk is read by column name)."""
    t = trained(spark, sf)
    scored = learn.score_population(t.model, _trained_members(spark, sf))
    return score_scenarios(scored, SCENARIOS, K)


def _nodes(spark, sf):
    """The node table of the fitted model, stored once beside it."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _NODES:
        _NODES[key] = materialize(forest.node_table(trained(spark, sf).model))
    return _NODES[key]


def l4_node_table(spark, sf):
    return _nodes(spark, sf)


def l6_score_by_nodes(spark, sf):
    """L6, F14 as joins with the node table (equal to L6_score_population)."""
    model = trained(spark, sf).model
    return forest.score_by_nodes(_trained_members(spark, sf), _nodes(spark, sf), model.getNumTrees,
                                 model.getOrDefault("maxDepth"))


def l11_importances_by_nodes(spark, sf):
    return forest.importances_by_nodes(_nodes(spark, sf))


def _tree(spark, sf):
    """(nodes, members): the single checkable tree, fitted on the training side."""
    m = _members_for(spark, sf, None)
    return tree.fit_tree(learn.split(m)[0]), m


def l4_gini_tree(spark, sf):
    nodes, _ = _tree(spark, sf)
    return nodes.select("node", "feature", round_even("threshold", 6).alias("threshold"),
                        round_even("gain", 9).alias("gain"), "pos", "neg")


def l5_tree_scores(spark, sf):
    """Test members with their leaf and its share of churn."""
    nodes, m = _tree(spark, sf)
    scored = tree.tree_scores(learn.split(m)[1], nodes)
    return scored.select("member_key", "node", "prediction", round_even("Churn_Risk_Score", 9).alias("Churn_Risk_Score"))


def l11_tree_importances(spark, sf):
    imp = tree.tree_importances(_tree(spark, sf)[0])
    return imp.select("feature", round_even("importance", 9).alias("importance"))


def l14_headline(spark, sf):
    return learn.headline(_metrics(spark, sf))


def w6_top_features(spark, sf):
    return learn.top_features(l11_importances(spark, sf))


def w7_importance_chart(spark, sf):
    return importance_chart(_metrics(spark, sf))


def d17_brief(spark, sf):
    return brief(_metrics(spark, sf))


QUERIES: dict[str, Query] = {
    "S8_preview": s8_preview,
    "P1_drop_columns": p1_drop_columns,
    "P2_churn_label": p2_churn_label,
    "P3_scored_columns": p3_scored_columns,
    "P4_scenario_columns": d15_score_scenarios,
    "P6_scenario_constants": p6_scenario_constants,
    "P7_allocation_text": p7_allocation_text,
    "P8_tier_alias": p8_tier_alias,
    "P9_member_id": p9_member_id,
    "P10_target_view": p10_target_view,
    "B1_churned": b1_churned,
    "B2_true_positives": b2_true_positives,
    "B3_sleeping_dogs": b3_sleeping_dogs,
    "B4_at_risk": b4_at_risk,
    "B5_target_rows": b5_target_rows,
    "B6_call_actions": b6_call_actions,
    "B7_email_fallback": b7_email_fallback,
    "B8_dog_override": b8_dog_override,
    "J1_member_scenarios": j1_member_scenarios,
    "J2_member_weights": j2_member_weights,
    "J3_population_scalars": j3_population_scalars,
    "J4_best_weight": j4_best_weight,
    "A1_row_count": a1_row_count,
    "A2_churn_rate": a2_churn_rate,
    "A3_class_weights": a3_class_weights,
    "A4_confusion": a4_confusion,
    "A5_precision_recall": a5_precision_recall,
    "A6_population_minmax": a6_population_minmax,
    "A7_max_expected_loss": a7_max_expected_loss,
    "A8_action_mix": a8_action_mix,
    "A9_tier_mix": a9_tier_mix,
    "A10_tenure_mix": a10_tenure_mix,
    "A11_scenario_summary": a11_scenario_summary,
    "A11_action_counts": a11_action_counts,
    "A12_target_kpis": a12_target_kpis,
    "A13_high_touch": a13_high_touch,
    "A14_population_age": a14_population_age,
    "A15_sweep_aggregates": d9_tradeoff_curve,
    "A16_objective": a16_objective,
    "A17_best_weight": d10_optimal_weight,
    "W1_global_rank": w1_global_rank,
    "W2_top_k_per_weight": w2_top_k_per_weight,
    "W3_top_k": d11_target_list,
    "W4_target_flag": w4_target_flag,
    "W5_full_sort": w5_full_sort,
    "W6_top_features": w6_top_features,
    "W7_importance_chart": w7_importance_chart,
    "W8_best_channel": w8_best_channel,
    "U1_union_scenarios": u1_union_scenarios,
    "F1_clip": f1_clip,
    "F2_arithmetic": f2_arithmetic,
    "F3_abs_gap": d13_fairness_check,
    "F4_round_even": f4_round_even,
    "F6_percent": f6_percent,
    "F7_tenure_band": f7_tenure_band,
    "F8_band_counts": f8_band_counts,
    "F10_money_text": f10_money_text,
    "F10_profile_text": f10_profile_text,
    "F10_fairness_text": f10_fairness_text,
    "F10_strategy_text": f10_strategy_text,
    "F12_min_max_scale": f12_min_max_scale,
    "F13_loyalty_direction": f13_loyalty_direction,
    "F14_vector_risk": l6_score_population,
    "D1_account_value": d1_account_value,
    "D2_save_probability": d2_save_probability,
    "D3_sleeping_dogs": d3_sleeping_dogs,
    "D4_channel_roi": d4_channel_roi,
    "D5_best_action": d5_best_action,
    "D5_action_summary": d5_action_summary,
    "D6_expected_value_saved": d6_expected_value_saved,
    "D7_loyalty_weight": d7_loyalty_weight,
    "D8_priority": d8_priority,
    "D9_tradeoff_curve": d9_tradeoff_curve,
    "D10_optimal_weight": d10_optimal_weight,
    "D11_target_list": d11_target_list,
    "D12_compare_strategies": d12_compare_strategies,
    "D13_fairness_check": d13_fairness_check,
    "D14_target_profile": d14_target_profile,
    "D15_score_scenarios": d15_score_scenarios,
    "D15_score_scenarios_learned": d15_score_scenarios_learned,
    "D16_expected_loss_priority": d16_expected_loss_priority,
    "D17_brief": d17_brief,
    "L1_index_tier": l1_index_tier,
    "L2_assemble": l2_assemble,
    "L3_split": l3_split,
    "L4_fit": l4_fit,
    "L5_score_test": l5_score_test,
    "L6_score_population": l6_score_population,
    "L7_roc_auc": l7_roc_auc,
    "L8_pr_auc": l8_pr_auc,
    "L9_accuracy": l9_accuracy,
    "L10_f1": l10_f1,
    "L7_rule_curve_areas": l7_rule_curve_areas,
    "L9_rule_count_scores": l9_rule_count_scores,
    "L11_importances": l11_importances,
    "L12_metrics": l12_metrics,
    "L13_scored_export": l13_scored_export,
    "L14_headline": l14_headline,
    "L4_node_table": l4_node_table,
    "L4_gini_tree": l4_gini_tree,
    "L5_tree_scores": l5_tree_scores,
    "L11_tree_importances": l11_tree_importances,
    "L6_score_by_nodes": l6_score_by_nodes,
    "L11_importances_by_nodes": l11_importances_by_nodes,
}
