"""Bucketed scans, rejected lines, replaced scenarios, states by file, one-pass lists and whole flows."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from retentio.constants import FEATURES, SCENARIOS
from retentio.operators import learn, report
from retentio.operators.decide import decide_scenarios
from retentio.operators.population import population_scalars, population_state, refresh_state, with_population
from retentio.operators.scenarios import action_maps, scenario_summary, score_scenarios
from retentio.operators.sweep import optimal_weight, tradeoff_curve
from retentio.plans.flows import train_score_export
from retentio.session import materialize
from retentio.sources import members as m
from retentio.sources.files import SCORED_COLUMNS, read_metrics, read_scored, replace_scenarios
from tests.conftest import SF0001

BASE = (SCENARIOS[1],)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_scan_skips_lines_after_the_label_period(spark):
    plan = plan_of(m.member_table(spark, SF0001))
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "l_shipdate" in line)
    assert "LessThan(l_shipdate,2000-10-01T00:00)" in scan.split("PushedFilters")[1]


def test_bucketed_orders_join_without_a_shuffle(spark, scratch):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    m.write_bucketed_orders(spark, SF0001, "retentio_bucket_test", scratch, 4)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        tables = m.bucketed_order_tables(spark, SF0001, "retentio_bucket_test")
        got = m.members_from_orders(*tables)
        plan = plan_of(got)
        assert "orderkey" not in "".join(line for line in plan.splitlines() if "Exchange" in line)
        assert "hashpartitioning(l_orderkey" in plan_of(m.member_table(spark, SF0001))  # as written, they shuffle
        want = m.member_table(spark, SF0001)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("drop database if exists retentio_bucket_test cascade")


HEADER = ",".join(f.name for f in m.RAW_MEMBER_SCHEMA.fields)
GOOD = "{},Existing Customer,44,Blue,36,4,2,3,5000.5,100.0,1.1,2000.25,40,0.9,0.02"


@pytest.mark.parametrize("mark", ["", m.BOM])
def test_unreadable_lines_are_kept_apart(spark, scratch, mark):
    lines = [GOOD.format(1), GOOD.format("x7"), GOOD.format(2).replace(",44,", ",forty,"), GOOD.format(3) + ",extra",
             "4,Existing Customer,44", GOOD.format(5).replace("Blue", '"Blue, bright"'), GOOD.format(6).replace(",36,", ",,")]
    path = os.path.join(scratch, "members.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write(mark + HEADER + "\n" + "\n".join(lines) + "\n")
    good, rejects = m.read_member_csv_with_rejects(spark, path)
    assert good.schema == m.RAW_MEMBER_SCHEMA
    assert sorted(r.CLIENTNUM for r in good.collect()) == [1, 5, 6]
    assert sorted(r.line for r in rejects.collect()) == sorted(lines[1:5])
    assert rejects.count() == 4 and {os.path.basename(r.file) for r in rejects.collect()} == {"members.csv"}
    # the same lines whatever columns are read
    assert good.select("Card_Category").count() == 3 and good.agg(F.sum("Customer_Age")).first()[0] == 132
    assert {r.Card_Category for r in good.collect()} == {"Blue", "Blue, bright"}
    clean = os.path.join(scratch, "clean.csv")
    with open(clean, "w", encoding="utf-8") as f:
        f.write(mark + HEADER + "\n" + lines[0] + "\n")
    assert [r.CLIENTNUM for r in m.read_member_csv(spark, clean).collect()] == [1]
    assert m.read_member_csv_with_rejects(spark, clean)[1].count() == 0


def test_replaced_scenario_leaves_the_others(spark, members_small, scratch):
    path = os.path.join(scratch, "scenarios")
    replace_scenarios(score_scenarios(members_small, SCENARIOS, 20), path)

    def files():
        return {n: sorted(os.listdir(os.path.join(path, n))) for n in os.listdir(path) if n.startswith("Scenario=")}

    first = files()
    again = score_scenarios(members_small, (SCENARIOS[0],), 5)
    name = f"Scenario={SCENARIOS[0][0]}".replace("%", "%25")
    for _ in range(2):  # a repeat changes nothing else either
        replace_scenarios(again, path)
        now = files()
        changed = [n for n in first if now[n] != first[n]]
        assert set(now) == set(first) and len(changed) == 1 and SCENARIOS[0][0].split()[0] in changed[0], name
        back = spark.read.parquet(path)
        got = {r.Scenario: r.n for r in back.groupBy("Scenario").agg(F.count_if("In_Target_List").alias("n")).collect()}
        assert got == {s: 5 if s == SCENARIOS[0][0] else 20 for s, _ in SCENARIOS}
        assert back.count() == 3 * members_small.count()


def test_state_by_file_equals_a_full_recompute(spark, members_small, scratch):
    folder, state = os.path.join(scratch, "members"), os.path.join(scratch, "state")
    parts = [members_small.filter(F.col("member_key") % 4 == k).coalesce(1) for k in range(4)]
    for k in (0, 1, 2):
        parts[k].write.parquet(os.path.join(folder, f"part={k}"))

    def check(expected_files):
        got, read = refresh_state(spark, folder, state)
        assert len(read) == expected_files
        now = decide_scenarios(spark.read.parquet(folder), SCENARIOS)
        rows = lambda df: sorted(map(tuple, df.collect()))
        assert rows(got) == rows(population_state(now).select(*got.columns))
        assert rows(got.select(*population_scalars(now).columns)) == rows(population_scalars(now))
        return {r.Scenario: r.pop_max_value for r in got.collect()}

    check(3)
    check(0)  # nothing new: no member file is read
    parts[3].withColumn("Total_Trans_Amt", F.lit(1e7)).withColumn("Months_on_book", F.lit(60)).write.parquet(
        os.path.join(folder, "part=3"))
    high = check(1)
    spark.read.parquet(os.path.join(folder, "part=0")).limit(3).write.parquet(os.path.join(scratch, "few"))
    # the file with the maxima is rewritten with few rows: only it is read, the maxima are found again
    spark.read.parquet(os.path.join(scratch, "few")).write.mode("overwrite").parquet(os.path.join(folder, "part=3"))
    low = check(1)
    assert all(low[s] < high[s] for s in low)
    got, _ = refresh_state(spark, folder, state)
    decided = decide_scenarios(spark.read.parquet(folder), SCENARIOS)
    a = with_population(decided, 0.5, scalars=got).select("member_key", "Scenario", "Loyalty_Weight", "Normalized_Value")
    b = with_population(decided, 0.5).select(*a.columns)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    with pytest.raises(Exception):
        refresh_state(spark, os.path.join(scratch, "absent"), os.path.join(scratch, "no_state"))


def _report_state(members):
    base = materialize(members, "table")
    decided = decide_scenarios(base, BASE)
    state = materialize(population_state(decided), "table")
    dec = with_population(decided, scalars=state)
    return dec, materialize(optimal_weight(tradeoff_curve(dec, 20)), "table"), state


def test_both_lists_come_from_one_scan(spark, members_small):
    dec, best, state = _report_state(members_small)
    for table in (report.compare_strategies(dec, best, 40, 20),
                  report.fairness_check(dec, best, 40, 20, population=state)):
        scans = [line for line in plan_of(table).splitlines() if "FileScan" in line and "Total_Trans_Amt" in line]
        assert len(scans) == 1
    opt = report.target_list(report.with_optimum(dec, best), "Optimal_Risk_Weight_Pct", 20)
    man = report.target_list(dec, 40, 20)
    lists = report.strategy_lists(dec, best, 40, 20, ("member_key", "Net_ROI")).collect()
    for name, want in (("optimal", opt), ("manual", man)):
        assert sorted((r.member_key, r.Net_ROI) for r in lists if r.Strategy == name) == sorted(
            (r.member_key, r.Net_ROI) for r in want.collect())
    with_state = report.fairness_check(dec, best, 40, 20, population=state).collect()
    assert with_state == report.fairness_check(dec, best, 40, 20).collect()


def test_texts_of_both_strategies(spark, members_small):
    t = report.what_if(members_small, margin=0.03, capacity=15, manual_weight=40)
    c, text = t["comparison"].first(), t["comparison_text"].first()
    w = c.Optimal_Risk_Weight_Pct
    assert text.Optimal_Allocation == f"{w}% Risk / {100 - w}% Value" and text.Manual_Allocation == "40% Risk / 60% Value"
    assert text.Manual_Net_ROI_Text == "$" + f"{c.Manual_Net_ROI:,.2f}" and text.Delta_Text.endswith(" vs optimum")


def test_action_counts_in_map_form(spark, members_small):
    table = score_scenarios(members_small, SCENARIOS, 20).cache()
    rows = {r.Scenario: r for r in scenario_summary(table).collect()}
    for r in action_maps(table).collect():
        s = rows[r.Scenario]
        assert sum(r.Actions.values()) == 20
        assert r.Actions.get("Automated Email", 0) == s.n_email and r.Actions.get("Flagged: Sleeping Dog", 0) == s.n_sleeping_dog
    table.unpersist()


def test_one_call_from_members_to_scores_and_metrics(spark, members_small, scratch):
    scored, metrics = os.path.join(scratch, "scored"), os.path.join(scratch, "metrics")
    head = train_score_export(members_small, scored, metrics, trees=5, depth=3).first()
    row = read_metrics(spark, metrics).first()
    assert (head.recall, head.roc_auc, head.top_feature) == (row.recall, row.roc_auc, row.top_features[0].feature)
    back = read_scored(spark, scored)
    assert back.columns == list(SCORED_COLUMNS) and back.count() == members_small.count()
    assert row.test_set_size == back.filter(~F.col("is_train")).count() and head.top_feature in FEATURES
    assert learn.METRICS_SCHEMA.fieldNames()[0] == "roc_auc"
