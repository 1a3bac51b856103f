"""Decision operators on hand-made edge fixtures."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from retentio.constants import EMAIL, REP_CALL, SENIOR_CALL, SLEEPING_DOG
from retentio.functions.scalar import member_id, round_even, tenure_band
from retentio.operators.decide import Costs, best_action, decide, sleeping_dogs

COLS = ("member_key long, Churn_Risk_Score double, Months_Inactive_12_mon int, Total_Ct_Chng_Q4_Q1 double, "
        "Months_on_book int, Total_Trans_Amt double, Total_Relationship_Count int, Card_Category string, "
        "Customer_Age int")


def _members(spark, rows):
    return spark.createDataFrame(rows, COLS)


def test_argmax_ties_pick_first_channel(spark):
    df = spark.createDataFrame([(1, 5.0, 5.0, 5.0, False), (2, 1.0, 7.0, 7.0, False), (3, -1.0, -2.0, -3.0, False)],
                               "member_key long, ROI_Email double, ROI_Rep double, ROI_Senior double, "
                               "Is_Sleeping_Dog boolean")
    out = {r.member_key: (r.Recommended_Action, r.Net_ROI) for r in best_action(df).collect()}
    assert out[1] == (EMAIL, 5.0)
    assert out[2] == (REP_CALL, 7.0)
    # nothing positive: email with its own (negative) ROI
    assert out[3] == (EMAIL, -1.0)


def test_email_fallback_when_email_is_dear(spark):
    # low value: every channel loses money; email costs 100
    m = _members(spark, [(1, 0.3, 1, 0.9, 30, 100.0, 1, "A", 40)])
    r = decide(m, 0.025, Costs(senior=40.0, rep=15.0, email=100.0)).first()
    assert r.Recommended_Action == EMAIL
    assert r.Net_ROI == pytest.approx(r.ROI_Email)
    assert r.ROI_Rep > r.ROI_Email  # rep is better, yet the rule falls back to email


def test_sleeping_dog_edges(spark):
    rows = [
        (1, 0.85, 4, 0.39, 30, 1000.0, 1, "A", 40),    # risk not strictly above
        (2, 0.8501, 4, 0.39, 30, 1000.0, 1, "A", 40),  # dog
        (3, 0.8501, 3, 0.39, 30, 1000.0, 1, "A", 40),  # inactive below 4
        (4, 0.8501, 4, 0.40, 30, 1000.0, 1, "A", 40),  # change not strictly below
    ]
    out = {r.member_key: r.Is_Sleeping_Dog for r in sleeping_dogs(_members(spark, rows)).collect()}
    assert out == {1: False, 2: True, 3: False, 4: False}
    d = {r.member_key: r for r in decide(_members(spark, rows)).collect()}
    assert d[2].Recommended_Action == SLEEPING_DOG and d[2].Net_ROI == 0.0 and d[2].Expected_Value_Saved == 0.0


def test_band_edges_right_closed(spark):
    months = [0, 1, 24, 25, 36, 48, 100, 101]
    df = spark.createDataFrame([(m,) for m in months], "m int")
    out = {r.m: r.b for r in df.select("m", tenure_band("m").alias("b")).collect()}
    assert out == {0: None, 1: "New (<2y)", 24: "New (<2y)", 25: "2-3y", 36: "2-3y", 48: "3-4y",
                   100: "Loyal (4y+)", 101: None}


def test_member_id_keeps_long_numbers(spark):
    df = spark.createDataFrame([(7,), (123456,)], "k long")
    assert [r.i for r in df.select(member_id("k").alias("i")).orderBy("i").collect()] == ["M00007", "M123456"]


def test_round_even_matches_numpy(spark):
    import numpy as np
    vals = [1.015, 2.675, 0.125, -0.125, 12345.675, 0.005]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r.y for r in df.select(round_even("x", 2).alias("y")).collect()]
    assert got == [float(np.round(v, 2)) for v in vals]


def test_value_formula(spark):
    m = _members(spark, [(1, 0.5, 2, 0.5, 30, 12000.0, 3, "A", 40)])
    r = decide(m, 0.025).first()
    years = min(max(30 / 12, 1.0), 6.0)
    assert r.Total_Account_Value == pytest.approx(12000.0 * 0.025 * years * (1 + (3 - 1) / 5 * 0.5))
    reach = min(max(1 - 2 / 6, 0.1), 1.0)
    respond = min(max(0.5, 0.1), 1.0)
    assert r.Save_Prob == pytest.approx(min(max(0.10 + 0.70 * (0.5 * reach + 0.5 * respond), 0.05), 0.85))
    stake = r.Total_Account_Value * 0.5
    assert r.ROI_Senior == pytest.approx(stake * r.Save_Prob * 1.0 - (40 + 12000 / 12 * 0.10))
    assert r.Recommended_Action in (EMAIL, REP_CALL, SENIOR_CALL)
    assert r.Net_ROI == pytest.approx(max(r.ROI_Email, r.ROI_Rep, r.ROI_Senior))


def test_null_inputs_stay_null(spark):
    m = _members(spark, [(1, 0.5, 2, None, 30, 1000.0, 1, "A", 40)])
    r = decide(m).select(F.col("Save_Prob")).first()
    assert r.Save_Prob is None
