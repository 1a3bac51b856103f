"""Property tests: Spark decisions against a plain-Python statement of the rules."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from retentio.constants import EMAIL, REP_CALL, SENIOR_CALL, SLEEPING_DOG
from retentio.operators.decide import Costs, decide
from retentio.operators.rank import global_rank

COLS = ("member_key long, Churn_Risk_Score double, Months_Inactive_12_mon int, Total_Ct_Chng_Q4_Q1 double, "
        "Months_on_book int, Total_Trans_Amt double, Total_Relationship_Count int, Card_Category string, "
        "Customer_Age int")


def _clip(x, lo, hi):
    return min(max(x, lo), hi)


def _expected(row, margin, costs):
    _, risk, inactive, chg, mob, amt, rel, _, _ = row
    years = _clip(mob / 12, 1.0, 6.0)
    value = amt * margin * years * (1.0 + (rel - 1) / 5 * 0.5)
    save = _clip(0.10 + 0.70 * (0.5 * _clip(1 - inactive / 6, 0.1, 1.0) + 0.5 * _clip(chg, 0.1, 1.0)), 0.05, 0.85)
    dog = risk > 0.85 and inactive >= 4 and chg < 0.4
    stake = value * risk
    roi = {EMAIL: stake * save * 0.5 - costs.email,
           REP_CALL: stake * save * 0.8 - (costs.rep + amt / 12 * 0.05),
           SENIOR_CALL: stake * save * 1.0 - (costs.senior + amt / 12 * 0.10)}
    best = max(roi.values())
    first = next(c for c in (EMAIL, REP_CALL, SENIOR_CALL) if roi[c] == best)
    if dog:
        return SLEEPING_DOG, 0.0
    if best > 0:
        return first, best
    return EMAIL, roi[EMAIL]


member = st.tuples(
    st.floats(0.0, 1.0, allow_nan=False),
    st.integers(0, 12),
    st.floats(0.0, 3.0, allow_nan=False),
    st.integers(0, 100),
    st.floats(0.0, 50000.0, allow_nan=False),
    st.integers(1, 6),
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(member, min_size=1, max_size=40),
       margin=st.sampled_from([0.01, 0.025, 0.04]),
       email_cost=st.sampled_from([0.10, 5.0, 100.0]))
def test_decisions_match_rules(spark, rows, margin, email_cost):
    data = [(i, r, inact, chg, mob, amt, rel, "T", 40) for i, (r, inact, chg, mob, amt, rel) in enumerate(rows)]
    costs = Costs(email=email_cost)
    got = {r.member_key: (r.Recommended_Action, r.Net_ROI)
           for r in decide(spark.createDataFrame(data, COLS), margin, costs).collect()}
    for row in data:
        action, roi = _expected(row, margin, costs)
        assert got[row[0]][0] == action
        assert got[row[0]][1] == pytest.approx(roi, rel=1e-12, abs=1e-9)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.integers(-3, 3), min_size=1, max_size=300),
       parts=st.integers(1, 9))
def test_global_rank_is_row_number(spark, values, parts):
    df = spark.createDataFrame([(i, i % 3, float(v)) for i, v in enumerate(values)], "k long, g long, p double")
    got = global_rank(df, [F.col("p").desc(), F.col("k")], ["g"], "r", num_partitions=parts)
    want = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy(F.col("p").desc(), "k")))
    assert sorted(got.select("k", "r").collect()) == sorted(want.select("k", "r").collect())
