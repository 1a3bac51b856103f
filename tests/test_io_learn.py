"""Sources and sinks, the model path (bounds) and the metrics brief."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from retentio.constants import FEATURES
from retentio.operators import learn
from retentio.operators.brief import brief, importance_chart
from retentio.operators.report import expected_loss_priority
from retentio.sources.files import SCORED_COLUMNS, read_metrics, read_scored, write_metrics, write_scenarios, write_scored
from retentio.sources.members import (
    MissingInputError, RAW_MEMBER_SCHEMA, drop_unused, read_member_csv, read_table, with_churn_flag,
)

# an invented document
SAMPLE_METRICS = {
    "roc_auc": 0.8125, "pr_auc": 0.5, "accuracy": 0.75, "f1": 0.7, "precision": 0.6, "recall": 0.55,
    "confusion": {"tp": 11, "fp": 7, "fn": 9, "tn": 33},
    "top_features": [{"feature": "Customer_Age", "importance": 0.4}, {"feature": "Credit_Limit", "importance": 0.25}],
    "test_set_size": 60,
}


def test_missing_input_names_the_path(spark, scratch):
    path = os.path.join(scratch, "nope", "members.csv")
    with pytest.raises(MissingInputError, match="members.csv"):
        read_table(spark, path, fmt="csv", schema=RAW_MEMBER_SCHEMA)


def test_member_csv_roundtrip_with_declared_schema(spark, members_small, scratch):
    raw = (members_small.select(F.col("member_key").alias("CLIENTNUM"), "Attrition_Flag", "Customer_Age",
                                "Card_Category", "Months_on_book", "Total_Relationship_Count",
                                "Months_Inactive_12_mon", "Contacts_Count_12_mon", "Credit_Limit",
                                "Total_Revolving_Bal", "Total_Amt_Chng_Q4_Q1", "Total_Trans_Amt",
                                "Total_Trans_Ct", "Total_Ct_Chng_Q4_Q1", "Avg_Utilization_Ratio"))
    path = os.path.join(scratch, "members_csv")
    wide = raw.select(*reversed(raw.columns), F.lit(0.5).alias("Extra_Score"), F.lit("x,y").alias("Extra_Text"))
    wide.write.option("header", True).csv(path)
    back = read_member_csv(spark, path)
    assert back.schema == RAW_MEMBER_SCHEMA
    assert back.exceptAll(raw).isEmpty() and raw.exceptAll(back).isEmpty()
    narrow = os.path.join(scratch, "narrow_csv")
    raw.drop("Total_Trans_Ct").write.option("header", True).csv(narrow)
    with pytest.raises(ValueError, match="Total_Trans_Ct"):
        read_member_csv(spark, narrow)
    for read in (read_scored, read_metrics, read_member_csv):
        with pytest.raises(MissingInputError):
            read(spark, os.path.join(scratch, "absent"))
    prepared = with_churn_flag(drop_unused(back))
    assert "CLIENTNUM" not in prepared.columns and "member_key" in prepared.columns
    assert prepared.count() == members_small.count()
    assert prepared.agg(F.sum("Churn_Flag")).first()[0] == members_small.agg(F.sum("Churn_Flag")).first()[0]


def test_metrics_json_document(spark, scratch):
    path = os.path.join(scratch, "metrics.json")
    with open(path, "w") as fh:
        json.dump(SAMPLE_METRICS, fh, indent=2)
    m = read_metrics(spark, path)
    r = m.first()
    assert r.confusion.tp == 11 and r.test_set_size == 60
    assert r.top_features[0].feature == "Customer_Age"
    lines = [x.text for x in brief(m).orderBy("line_no").collect()]
    assert "0.813" in lines[1] or "0.812" in lines[1]
    assert "Customer Age" in lines[2]
    assert lines[3] == "In the test split the model found 11 leavers and overlooked 9."
    chart = [x.Feature for x in importance_chart(m).collect()]
    assert chart == ["Credit Limit", "Customer Age"]


def test_no_predicted_positives_gives_zero_precision(spark):
    df = spark.createDataFrame([(1, 0.0), (0, 0.0), (1, 0.0)], "Churn_Flag int, prediction double")
    r = learn.confusion(df).first()
    assert (r.tp, r.fp, r.fn, r.tn, r.test_set_size) == (0, 0, 2, 1, 3)
    assert r.precision == 0.0 and r.recall == 0.0


def test_model_path_bounds_and_writers(spark, members_small, scratch):
    t = learn.train_and_evaluate(members_small, trees=10, depth=4)
    metrics = learn.metrics_table(t.predictions, t.model)
    r = metrics.first()
    for k in ("roc_auc", "pr_auc", "accuracy", "f1", "precision", "recall", "churn_f1"):
        assert 0.0 <= getattr(r, k) <= 1.0
    c = r.confusion
    assert c.tp + c.fp + c.fn + c.tn == r.test_set_size == t.test.count()
    assert len(r.top_features) == 5
    imp = learn.importances(t.model)
    assert imp.count() == len(FEATURES)
    assert imp.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    scored = expected_loss_priority(learn.score_population(t.model, members_small))
    bounds = scored.agg(F.min("Churn_Risk_Score"), F.max("Churn_Risk_Score"),
                        F.max("Priority_Score"), F.count("*")).first()
    assert 0.0 <= bounds[0] <= bounds[1] <= 1.0 and bounds[2] == 100.0
    assert bounds[3] == members_small.count()
    # S5 / S7 / S4 / S2 round trips
    write_scored(scored, os.path.join(scratch, "scored_csv"))
    back = read_scored(spark, os.path.join(scratch, "scored_csv"), fmt="csv")
    assert back.count() == members_small.count()
    assert back.columns == list(SCORED_COLUMNS)
    top = back.orderBy(F.col("Priority_Score").desc()).first()
    assert top.Priority_Score == 100.0
    assert back.filter(F.col("Churn_Risk_Score") > 1.0).count() == 0
    write_metrics(metrics, os.path.join(scratch, "metrics"))
    assert read_metrics(spark, os.path.join(scratch, "metrics")).first().test_set_size == r.test_set_size
    assert learn.headline(metrics).first().top_feature in FEATURES


def test_scenario_sink_partitions_by_scenario(spark, members_small, scratch):
    from retentio.constants import SCENARIOS
    from retentio.operators.scenarios import score_scenarios
    path = os.path.join(scratch, "scenarios")
    write_scenarios(score_scenarios(members_small, SCENARIOS, capacity=20), path)
    folders = {p for p in os.listdir(path) if p.startswith("Scenario=")}
    assert len(folders) == len(SCENARIOS)
    back = spark.read.parquet(path)
    assert back.count() == 3 * members_small.count()
    one = back.filter(F.col("Scenario") == SCENARIOS[0][0])
    assert one.count() == members_small.count()


def test_split_takes_any_key(spark):
    strided = spark.range(0, 3_000_000, 1000).withColumnRenamed("id", "member_key")
    for keys in (strided, strided.select((-F.col("member_key")).alias("member_key")),
                 strided.select(F.concat(F.lit("k"), F.col("member_key")).alias("member_key"))):
        train, test = learn.split(keys)
        assert train.count() + test.count() == 3000 and 480 < test.count() < 720
    nulls = spark.sql("select cast(null as bigint) member_key from range(5)")
    assert learn.split(nulls)[0].count() == 5


def test_split_is_stable_and_about_a_fifth(spark, members_small):
    train, test = learn.split(members_small)
    n, nt = members_small.count(), test.count()
    assert train.count() + nt == n
    assert 0.1 < nt / n < 0.3
    again = learn.split(members_small.repartition(3))[1]
    assert sorted(r.member_key for r in test.collect()) == sorted(r.member_key for r in again.collect())


def test_streaming_decisions_equal_batch(spark, members_small, scratch):
    from retentio.streaming.decisions import MEMBER_SCHEMA, decision_stream, start_decision_stream
    src = os.path.join(scratch, "in")
    members_small.select(*[f.name for f in MEMBER_SCHEMA.fields]).repartition(3).write.parquet(src)
    q = start_decision_stream(spark, src, os.path.join(scratch, "out"), os.path.join(scratch, "ckpt"))
    q.awaitTermination(120)
    got = spark.read.parquet(os.path.join(scratch, "out")).drop("scored_at")
    want = decision_stream(members_small)
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_target_profile_keeps_empty_bands(spark, members_small):
    from retentio.constants import SCENARIOS
    from retentio.operators.report import target_list, target_profile
    from retentio.operators.scenarios import scenario_decisions
    dec = scenario_decisions(members_small, (SCENARIOS[1],))
    tl = target_list(dec, 100, 3)  # three members: most bands are empty
    prof = target_profile(tl)
    bands = prof["by_tenure"].collect()
    assert [b.Tenure_Band for b in bands] == ["New (<2y)", "2-3y", "3-4y", "Loyal (4y+)"]
    assert sum(b.Count for b in bands) <= 3 and any(b.Count == 0 for b in bands)
    k = prof["kpis"].first()
    assert k.Target_List_Size == 3 and 0 <= k.High_Touch_Calls <= 3
    assert sum(r.Count for r in prof["by_tier"].collect()) == 3


def test_what_if_tables(spark, members_small):
    from retentio.operators.report import what_if
    t = what_if(members_small, margin=0.03, capacity=15, manual_weight=40)
    assert t["curve"].count() == 51
    assert t["optimal_list"].count() == 15 and t["manual_list"].count() == 15
    c = t["comparison"].first()
    assert c.Manual_Risk_Weight_Pct == 40
    assert c.Delta_vs_Optimum == pytest.approx(c.Manual_Net_ROI - c.Optimal_Net_ROI, abs=1e-3)
    assert t["fairness"].count() == 2
    assert sum(r.Count for r in t["optimal_mix"].collect()) == 15


def test_export_scenarios_summary(spark, members_small, scratch):
    from retentio.constants import SCENARIOS
    from retentio.operators.scenarios import export_scenarios, score_scenarios, scenario_summary
    path = os.path.join(scratch, "export")
    got = sorted(export_scenarios(members_small, path, capacity=20).collect())
    want = sorted(scenario_summary(score_scenarios(members_small, SCENARIOS, 20)).collect())
    assert [(r.Scenario, r.Optimal_Risk_Weight_Pct, r.Target_List_Size) for r in got] == \
        [(r.Scenario, r.Optimal_Risk_Weight_Pct, r.Target_List_Size) for r in want]


def test_count_scores_equal_mllib_evaluator(spark, members_small):
    t = learn.train_and_evaluate(members_small, trees=8, depth=4)
    c = learn.confusion(t.predictions).first()
    derived = learn.count_scores(c.tp, c.fp, c.fn, c.tn)
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    for name in ("accuracy", "f1"):
        mllib = MulticlassClassificationEvaluator(labelCol="Churn_Flag", predictionCol="prediction", metricName=name)
        assert derived[name] == pytest.approx(mllib.evaluate(t.predictions), abs=1e-12)


def test_curve_bins(spark):
    """0 bins are exact; few bins merge scores and move the areas."""
    rows = [(float(i % 97) / 97, int((i * i) % 7 < 3)) for i in range(2000)]
    pred = spark.createDataFrame(rows, "rawPrediction double, Churn_Flag int")
    exact = learn.curve_scores(pred)
    wins = sum((a > b) + (a == b) / 2 for a, y in rows if y for b, z in rows if not z)
    n = sum(y for _, y in rows)
    assert exact["roc_auc"] == pytest.approx(wins / (n * (len(rows) - n)), abs=1e-12)
    assert learn.curve_scores(pred, num_bins=1000) == exact  # fewer distinct scores than bins
    assert learn.curve_scores(pred, num_bins=5) != exact


def test_count_scores_reproduce_published_metrics():
    s = learn.count_scores(tp=255, fp=74, fn=29, tn=1588)
    assert round(s["accuracy"], 4) == 0.9471
    assert round(s["f1"], 4) == 0.9487


def test_streaming_restart_is_exactly_once(spark, members_small, scratch):
    from retentio.streaming.decisions import MEMBER_SCHEMA, start_decision_stream
    src, out, ckpt = (os.path.join(scratch, x) for x in ("in", "out", "ckpt"))
    cols = [f.name for f in MEMBER_SCHEMA.fields]
    one_tier = members_small.select("Card_Category").orderBy("Card_Category").first()[0]
    first = members_small.filter(F.col("Card_Category") == one_tier).select(*cols)
    second = members_small.filter(F.col("Card_Category") != one_tier).select(*cols)
    first.write.parquet(os.path.join(src, "batch1"))
    start_decision_stream(spark, src + "/*", out, ckpt).awaitTermination(120)
    n1 = spark.read.parquet(out).count()
    # rerun with nothing new: the checkpoint says everything was processed
    start_decision_stream(spark, src + "/*", out, ckpt).awaitTermination(120)
    assert spark.read.parquet(out).count() == n1 == first.count()
    # new files: only they are scored
    second.write.parquet(os.path.join(src, "batch2"))
    start_decision_stream(spark, src + "/*", out, ckpt).awaitTermination(120)
    got = spark.read.parquet(out)
    assert got.count() == members_small.count()
    assert got.select("member_key").distinct().count() == members_small.count()


def test_scenarios_on_learned_risk(spark, members_small):
    from retentio.constants import SCENARIOS
    from retentio.operators.scenarios import score_scenarios
    t = learn.train_and_evaluate(members_small, trees=10, depth=4)
    scored = learn.score_population(t.model, members_small)
    tab = score_scenarios(scored, SCENARIOS, capacity=20).cache()
    n = members_small.count()
    assert tab.count() == 3 * n
    agg = tab.groupBy("Scenario").agg(F.max("Priority_Rank").alias("hi"), F.count_if("In_Target_List").alias("k"))
    assert all(r.hi == n and r.k == 20 for r in agg.collect())
    assert tab.filter((F.col("Churn_Risk_Score") < 0) | (F.col("Churn_Risk_Score") > 1)).count() == 0
    tab.unpersist()


def _curve_cases():
    yield "spread", [(float(i % 997) / 997, int((i * i) % 7 < 3)) for i in range(3000)]
    yield "ties", [(float(i % 5) / 4, int(i % 3 == 0)) for i in range(900)]
    yield "one cell", [(0.5 + (i % 400) * 1e-9, int((i * 7) % 11 < 4)) for i in range(1500)]
    yield "beyond the range", [(float(i % 50) - 20, int(i % 4 == 1)) for i in range(500)]
    yield "one score", [(0.25, i % 2) for i in range(40)]


def test_curve_counts_equal_the_evaluator(spark):
    for name, rows in _curve_cases():
        pred = spark.createDataFrame([(*r, float(r[0] > 0.5)) for r in rows],
                                     "rawPrediction double, Churn_Flag int, prediction double").repartition(5)
        want = learn.curve_scores(pred)
        got = learn.curve_counts(pred, score="rawPrediction").first()
        assert (got.roc_auc, got.pr_auc) == pytest.approx((want["roc_auc"], want["pr_auc"]), abs=1e-12), name
        c = learn.confusion(pred).first()
        assert (got.tp, got.fp, got.fn, got.tn) == (c.tp, c.fp, c.fn, c.tn)
    for label, areas in ((1, (1.0, 1.0)), (0, (0.0, 0.0))):
        pred = spark.createDataFrame([(0.1, label, 0.0), (0.7, label, 1.0)],
                                     "Churn_Risk_Score double, Churn_Flag int, prediction double")
        r = learn.curve_counts(pred).first()
        assert (r.roc_auc, r.pr_auc) == pytest.approx(areas)
    none = learn.with_count_scores(learn.curve_counts(pred.limit(0))).first()
    assert none.test_set_size == 0 and none.accuracy == 0.0


def test_metrics_are_a_lazy_plan(spark, members_small):
    t = learn.train_and_evaluate(members_small, trees=6, depth=4)
    want = learn.curve_scores(t.predictions)
    group = "metrics-plan"
    spark.sparkContext.setJobGroup(group, "building the metrics plan")
    plan = learn.metrics_table(t.predictions, t.model, places=12)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setJobGroup("other", "")
    assert not jobs
    r = plan.first()
    assert (r.roc_auc, r.pr_auc) == pytest.approx((want["roc_auc"], want["pr_auc"]), abs=1e-10)
    counts = learn.confusion(t.predictions).first()
    scores = learn.count_scores(counts.tp, counts.fp, counts.fn, counts.tn)
    assert (r.accuracy, r.f1) == pytest.approx((scores["accuracy"], scores["f1"]), abs=1e-10)
