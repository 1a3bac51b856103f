"""Sweep, optimum and ranking: checked values, brute force and properties."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from retentio.constants import SCENARIOS, SLEEPING_DOG
from retentio.operators.rank import global_rank
from retentio.operators.scenarios import scenario_decisions, score_scenarios
from retentio.operators.sweep import optimal_weight, tradeoff_curve

BASE = (SCENARIOS[1],)


def _brute_force_curve(pdf, capacity):
    """Pandas/NumPy version of the sweep (ties by member key)."""
    out = []
    risk = pdf.Churn_Risk_Score.to_numpy()
    nv = pdf.Normalized_Value.to_numpy()
    lw = pdf.Loyalty_Weight.to_numpy()
    dog = pdf.Is_Sleeping_Dog.to_numpy()
    key = pdf.member_key.to_numpy()
    roi = pdf.Net_ROI.to_numpy()
    for w in range(0, 101, 2):
        p = (risk * w / 100 + nv * (100 - w) / 100) * lw
        p[dog] = -1.0
        order = np.lexsort((key, -p))[:capacity]
        out.append((w, round(float(roi[order].sum()), 4), int((risk[order] > 0.5).sum())))
    return out


def test_fixture_values_sf0001(spark, members_small):
    dec = scenario_decisions(members_small, BASE)
    curve = tradeoff_curve(dec, 20).orderBy("Risk_Weight_Pct").collect()
    assert len(curve) == 51
    by_w = {r.Risk_Weight_Pct: r for r in curve}
    best = optimal_weight(tradeoff_curve(dec, 20)).first()
    assert best.Optimal_Risk_Weight_Pct == 64
    assert by_w[64].Captured_Net_ROI == pytest.approx(3262.9452, abs=1e-4)
    assert by_w[64].At_Risk_Reached == 20
    assert (by_w[0].Captured_Net_ROI, by_w[0].At_Risk_Reached) == (pytest.approx(2790.9252, abs=1e-4), 0)
    assert (by_w[100].Captured_Net_ROI, by_w[100].At_Risk_Reached) == (pytest.approx(2391.1424, abs=1e-4), 20)


def test_curve_matches_brute_force(spark, members_small):
    dec = scenario_decisions(members_small, BASE)
    pdf = dec.select("member_key", "Churn_Risk_Score", "Normalized_Value", "Loyalty_Weight",
                     "Is_Sleeping_Dog", "Net_ROI").toPandas()
    want = _brute_force_curve(pdf, 20)
    got = [(r.Risk_Weight_Pct, r.Captured_Net_ROI, r.At_Risk_Reached)
           for r in tradeoff_curve(dec, 20).orderBy("Risk_Weight_Pct").collect()]
    assert [g[0] for g in got] == [w[0] for w in want]
    for g, w in zip(got, want):
        assert g[1] == pytest.approx(w[1], abs=1e-3) and g[2] == w[2]


@pytest.mark.parametrize("capacity", [5, 20, 400])
def test_prune_is_exact(spark, members_small, capacity):
    dec = scenario_decisions(members_small, SCENARIOS)
    a = tradeoff_curve(dec, capacity, fraction=0.0).orderBy("Scenario", "Risk_Weight_Pct").collect()
    b = tradeoff_curve(dec, capacity, fraction=0.5).orderBy("Scenario", "Risk_Weight_Pct").collect()
    assert a == b


def test_capacity_above_rows_takes_all(spark, members_small):
    dec = scenario_decisions(members_small.limit(5), BASE)
    curve = tradeoff_curve(dec, 10).collect()
    total = dec.agg(F.sum("Net_ROI")).first()[0]
    assert len(curve) == 51
    assert all(r.Captured_Net_ROI == pytest.approx(total, abs=1e-3) for r in curve)


@pytest.mark.parametrize("how", ["table", "checkpoint", "persist"])
def test_global_rank_equals_row_number_under_skew(spark, how):
    # a third of the rows share one priority (like sleeping dogs at -1)
    n = 3000
    df = spark.range(n).select(
        F.col("id").alias("k"),
        (F.col("id") % 2).cast("string").alias("g"),
        F.when(F.col("id") % 3 == 0, F.lit(-1.0)).otherwise((F.col("id") * 7919 % 1000) / 10.0).alias("p"))
    ranked = global_rank(df, [F.col("p").desc(), F.col("k")], ["g"], "r", num_partitions=7, how=how)
    w = Window.partitionBy("g").orderBy(F.col("p").desc(), F.col("k"))
    want = df.withColumn("r", F.row_number().over(w))
    a = sorted((x.k, x.r) for x in ranked.select("k", "r").collect())
    b = sorted((x.k, x.r) for x in want.select("k", "r").collect())
    assert a == b


def test_scenario_table_properties(spark, members_small):
    t = score_scenarios(members_small, SCENARIOS, capacity=20, full=True).cache()
    n = members_small.count()
    per = {r.Scenario: r for r in t.groupBy("Scenario").agg(
        F.count("*").alias("n"), F.count_if("In_Target_List").alias("targets"),
        F.min("Priority_Rank").alias("lo"), F.max("Priority_Rank").alias("hi"),
        F.countDistinct("Priority_Rank").alias("distinct_ranks")).collect()}
    assert set(per) == {s for s, _ in SCENARIOS}
    for r in per.values():
        assert (r.n, r.targets, r.lo, r.hi, r.distinct_ranks) == (n, min(20, n), 1, n, n)
    # dogs rank below every other member
    bad = t.groupBy("Scenario").agg(
        F.min(F.when(F.col("Recommended_Action") == SLEEPING_DOG, F.col("Priority_Rank"))).alias("dog_min"),
        F.max(F.when(F.col("Recommended_Action") != SLEEPING_DOG, F.col("Priority_Rank"))).alias("other_max"))
    for r in bad.collect():
        assert r.dog_min is None or r.dog_min > r.other_max
    # chosen ROI is the best channel when that is positive
    viol = t.filter((F.col("Recommended_Action") != SLEEPING_DOG)
                    & (F.greatest("ROI_Email", "ROI_Rep", "ROI_Senior") > 0)
                    & (F.col("Net_ROI") < F.greatest("ROI_Email", "ROI_Rep", "ROI_Senior"))).count()
    assert viol == 0
    t.unpersist()


def test_one_tenure_for_all_counts_as_tenure_zero(spark):
    from retentio.operators.population import with_population
    df = spark.createDataFrame([("s", 1, 30, 10.0), ("s", 2, 30, 20.0), ("s", 3, 30, 5.0)],
                               "Scenario string, member_key long, Months_on_book int, Total_Account_Value double")
    out = with_population(df, loyalty=0.5).collect()
    assert all(r.Loyalty_Weight == 1.0 for r in out)
    for loyalty, weight in ((0.0, 1.0), (-0.5, 1.25)):
        assert {r.Loyalty_Weight for r in with_population(df, loyalty=loyalty).collect()} == {weight}
    assert sorted(r.Normalized_Value for r in out) == [0.25, 0.5, 1.0]


@pytest.mark.parametrize("loyalty", [-0.5, 0.0, 0.5])
def test_suppressed_last_and_unscored_in_no_list(spark, members_small, loyalty):
    flat = members_small.withColumn("Months_on_book", F.lit(30)).withColumn(
        "Churn_Risk_Score", F.when(F.col("member_key") % 10 == 0, F.lit(None)).otherwise(F.col("Churn_Risk_Score")))
    n = flat.count()
    rows = score_scenarios(flat, BASE, capacity=n, loyalty=loyalty, full=True).collect()
    unscored = [r.Priority_Rank for r in rows if r.Priority_Score is None]
    dogs = [r.Priority_Rank for r in rows if r.Is_Sleeping_Dog]
    others = [r.Priority_Rank for r in rows if r.Priority_Score is not None and not r.Is_Sleeping_Dog]
    assert max(others) < min(dogs) and max(dogs) < min(unscored)
    assert not any(r.In_Target_List for r in rows if r.Priority_Score is None)
    assert {r.Recommended_Action for r in rows if r.Priority_Score is None} == {"Not Scored"}


def test_row_local_queries_read_the_lines_once(spark):
    from retentio.plans import catalog
    from tests.conftest import SF001  # not the folder a fixture caches
    for q in (catalog.d1_account_value, catalog.d5_best_action, catalog.b3_sleeping_dogs, catalog.w8_best_channel,
              catalog.f4_round_even, catalog.a14_population_age):
        plan = q(spark, SF001)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet [l_") == 1, (q.__name__, plan)


def test_no_range_shuffle_where_no_rank_is_asked(spark):
    from retentio.plans import catalog
    from tests.conftest import SF0001
    for q in (catalog.p6_scenario_constants, catalog.p7_allocation_text, catalog.b5_target_rows,
              catalog.a11_scenario_summary, catalog.w4_target_flag, catalog.j4_best_weight):
        assert "rangepartitioning" not in q(spark, SF0001)._jdf.queryExecution().executedPlan().toString(), q.__name__


def test_large_capacity_changes_no_setting(spark):
    from retentio.operators.rank import top_k_per_group
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), F.col("id").alias("k"))
    before = dict(spark.conf.getAll)
    top = top_k_per_group(df, ["g"], [F.col("k").desc()], 1500, key="k")
    assert top.count() == 3 * 1500 and top.agg(F.max("rn")).first()[0] == 1500
    assert dict(spark.conf.getAll) == before


def _sweep_rows(kind: str, n: int = 1500):
    """(risk, value, loyalty, dog) by member key: smooth, tied, copied, degenerate and odd populations."""
    rng = np.random.default_rng(8)
    risk, value, loyal = rng.random(n), rng.lognormal(0, 2, n), 1 + 0.5 * rng.random(n)
    value /= value.max()
    dog = rng.random(n) < 0.3
    if kind == "ties":  # capped, rounded and with few values
        risk, value, loyal = np.minimum(1, np.round(risk * 1.4, 1)), np.round(value, 2), np.ones(n)
    elif kind == "copies":  # a third share one row at the very top
        risk[::3], value[::3], loyal[::3], dog[::3] = 1.0, 1.0, 1.5, False
    elif kind == "one":
        risk[:], value[:], loyal[:] = 0.25, 0.5, 1.0
    elif kind == "against":  # no row beats another
        risk = np.sort(rng.random(n))
        value, loyal, dog = 1 - risk, np.ones(n), np.zeros(n, bool)
    elif kind == "close":  # neighbours differ by single roundings
        risk, loyal, dog = 0.5 + np.arange(n) % 7 * 2.0 ** -53, np.ones(n), np.zeros(n, bool)
        value = 0.5 + np.arange(n) % 5 * 2.0 ** -53
    return risk, value, loyal, dog


@pytest.mark.parametrize("kind", ["smooth", "ties", "copies", "one", "against", "close"])
def test_skyband_equals_brute_force(spark, kind):
    from retentio.operators.sweep import pruned_priorities, top_rows
    risk, value, loyal, dog = _sweep_rows(kind)
    n = len(risk)
    key = np.random.default_rng(1).permutation(n)
    rows = [("s", int(key[i]), float(risk[i]), float(value[i]), float(loyal[i]), bool(dog[i]), float(i))
            for i in range(n)] + [("s", n + 1, None, 0.9, 1.0, None, 1.0), ("s", n + 2, 0.9, None, 1.0, False, 1.0)]
    df = spark.createDataFrame(rows, "Scenario string, member_key long, Churn_Risk_Score double, "
                               "Normalized_Value double, Loyalty_Weight double, Is_Sleeping_Dog boolean, "
                               "Net_ROI double").repartition(4).cache()
    for capacity in (1, 100, n + 10):
        got: dict = {}
        for r in top_rows(pruned_priorities(df, capacity), capacity, ["Scenario"]).collect():
            got.setdefault(r.w, {})[r.rn] = r.member_key
        assert sorted(got) == list(range(0, 101, 2))
        for w in range(0, 101, 2):
            p = (risk * w / 100 + value * (100 - w) / 100) * loyal
            p[dog] = -1.0
            want = key[np.lexsort((key, -p))[:capacity]].tolist()
            assert [got[w][k] for k in sorted(got[w])] == want, (kind, capacity, w)
    df.unpersist()


def test_skyband_drops_most_rows_and_draws_no_sample(spark):
    from retentio.operators.sweep import pruned_priorities, skyband
    df = spark.range(40_000).select(
        (F.col("id") % 2).cast("string").alias("Scenario"), F.col("id").alias("member_key"), F.rand(1).alias("Churn_Risk_Score"),
        F.rand(2).alias("Normalized_Value"), F.lit(1.0).alias("Loyalty_Weight"),
        (F.rand(3) < 0.3).alias("Is_Sleeping_Dog"), F.lit(1.0).alias("Net_ROI"))
    kept = skyband(df, 100).count()
    assert 200 <= kept < 5000
    assert pruned_priorities(df, 100).count() < 100_000  # of 2,040,000
    plan = pruned_priorities(df, 100)._jdf.queryExecution().toString()
    assert "Sample" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("pieces", [1, 2, 7, 40])
def test_counted_rank_equals_row_number(spark, pieces):
    """Hot values, nulls, NaN, a group without values, null groups and keys of either type."""
    from retentio.operators.rank import counted_rank
    n = 4000
    df = spark.range(n).select(
        (F.col("id") * 7919 % n).alias("k"),
        F.when(F.col("id") % 5 < 3, (F.col("id") % 2).cast("string")).when(F.col("id") % 5 == 3, "none").alias("g"),
        F.when((F.col("id") % 5 == 3) | (F.col("id") % 17 == 0), F.lit(None)).when(F.col("id") % 19 == 0, float("nan"))
        .when(F.col("id") % 3 == 0, -1.0).otherwise((F.col("id") * 31 % 500) / 10.0).alias("p"))
    w = Window.partitionBy("g").orderBy(F.col("p").desc_nulls_last(), F.col("k"))
    for rows in (df, df.withColumn("k", F.format_string("key%05d", "k"))):
        want = rows.withColumn("r", F.row_number().over(w))
        got = counted_rank(rows, "p", "k", ["g"], "r", pieces)
        key = lambda x: str(x)
        assert sorted(((x.g, x.k, x.r) for x in got.collect()), key=key) == sorted(
            ((x.g, x.k, x.r) for x in want.select("g", "k", "r").collect()), key=key)
    assert counted_rank(df.limit(0), "p", "k", ["g"], "r", pieces).count() == 0


def test_rank_sorts_narrow_rows_and_shuffles_members_once(spark, members_small):
    from retentio.session import materialize
    table = score_scenarios(materialize(members_small, "table"), SCENARIOS, capacity=20)
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    sorted_rows = [line for line in plan.splitlines() if "row_number()" in line and "_at#" in line]
    assert sorted_rows and all("Credit_Limit" not in x and "Total_Account_Value" not in x for x in sorted_rows)
    assert "rangepartitioning" not in table._jdf.queryExecution().executedPlan().toString()


def test_repeated_member_keys_are_refused(spark, members_small):
    twice = members_small.unionByName(members_small.limit(3))
    with pytest.raises(Exception, match="member_key is not unique"):
        score_scenarios(twice, BASE, capacity=5).collect()
