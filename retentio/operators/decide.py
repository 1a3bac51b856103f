"""Per-member decision operators (row-local: projections only, no shuffle).

Every function is ``DataFrame -> DataFrame`` and chains with ``.transform``.
The margin can be a float or a column, so one plan scores several margin
scenarios at once (see :func:`with_scenarios`).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentio.constants import (
    AT_RISK, COST_EMAIL, COST_REP, COST_SENIOR, DEFAULT_MARGIN, DOG_CT_CHANGE, DOG_INACTIVE,
    DOG_RISK, EFFECTIVENESS, EMAIL, REP_CALL, REP_WAIVER_RATE, SCENARIOS, SENIOR_CALL,
    SENIOR_WAIVER_RATE, SLEEPING_DOG,
)
from retentio.functions.scalar import clip

RISK = "Churn_Risk_Score"
UNSCORED = "Not Scored"  # action of a member whose inputs leave every ROI null


@dataclass(frozen=True)
class Costs:
    senior: float = COST_SENIOR
    rep: float = COST_REP
    email: float = COST_EMAIL


def _lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def with_scenarios(df: DataFrame, scenarios=SCENARIOS) -> DataFrame:
    """One row per member and scenario, with ``Scenario`` and ``margin``.

    The scenario list is a driver-side parameter; it is expanded with a
    generator (no join), so each member row is read once.
    """
    arr = F.array(*[F.struct(F.lit(name).alias("Scenario"), F.lit(float(m)).alias("margin"))
                    for name, m in scenarios])
    return df.select("*", F.inline(arr))


def account_value(df: DataFrame, margin: float | Column = DEFAULT_MARGIN) -> DataFrame:
    """Years on book (1-6), margin on spend, CLV, relationship multiplier, value."""
    m = _lit(margin)
    years = clip(F.col("Months_on_book") / F.lit(12), 1.0, 6.0)
    return (
        df.withColumn("Annual_Margin", F.col("Total_Trans_Amt") * m)
        .withColumn("Expected_Retention_Years", years)
        .withColumn("CLV", F.col("Annual_Margin") * F.col("Expected_Retention_Years"))
        .withColumn("Relationship_Multiplier",
                    F.lit(1.0) + (F.col("Total_Relationship_Count") - F.lit(1)) / F.lit(5) * F.lit(0.5))
        .withColumn("Total_Account_Value", F.col("CLV") * F.col("Relationship_Multiplier"))
        .withColumn("Segment", F.col("Card_Category"))
    )


def save_probability(df: DataFrame) -> DataFrame:
    """Reachability (recent activity) and responsiveness (count momentum)."""
    reach = clip(F.lit(1) - F.col("Months_Inactive_12_mon") / F.lit(6), 0.1, 1.0)
    respond = clip(F.col("Total_Ct_Chng_Q4_Q1"), 0.1, 1.0)
    return df.withColumn(
        "Save_Prob",
        clip(F.lit(0.10) + F.lit(0.70) * (F.lit(0.5) * reach + F.lit(0.5) * respond), 0.05, 0.85))


def sleeping_dog_flag() -> Column:
    return ((F.col(RISK) > F.lit(DOG_RISK))
            & (F.col("Months_Inactive_12_mon") >= F.lit(DOG_INACTIVE))
            & (F.col("Total_Ct_Chng_Q4_Q1") < F.lit(DOG_CT_CHANGE)))


def sleeping_dogs(df: DataFrame) -> DataFrame:
    """D3: high risk and already gone quiet."""
    return df.withColumn("Is_Sleeping_Dog", sleeping_dog_flag())


def roi_column(channel: str) -> str:
    return {EMAIL: "ROI_Email", REP_CALL: "ROI_Rep", SENIOR_CALL: "ROI_Senior"}[channel]


def channel_roi(df: DataFrame, costs: Costs = Costs(), effectiveness=None) -> DataFrame:
    """Value at stake and the net ROI of each channel."""
    eff = dict(EFFECTIVENESS if effectiveness is None else effectiveness)
    monthly = F.col("Total_Trans_Amt") / F.lit(12)
    cost = {
        EMAIL: F.lit(float(costs.email)),
        REP_CALL: F.lit(float(costs.rep)) + monthly * F.lit(REP_WAIVER_RATE),
        SENIOR_CALL: F.lit(float(costs.senior)) + monthly * F.lit(SENIOR_WAIVER_RATE),
    }
    out = df.withColumn("Value_At_Stake", F.col("Total_Account_Value") * F.col(RISK))
    for ch in (EMAIL, REP_CALL, SENIOR_CALL):
        out = out.withColumn(
            roi_column(ch),
            F.col("Value_At_Stake") * F.col("Save_Prob") * F.lit(float(eff[ch])) - cost[ch])
    return out


def best_channel() -> tuple[Column, Column]:
    """(channel, ROI) of the best channel, the first in channel order on ties."""
    e, r, s = (F.col(roi_column(c)) for c in (EMAIL, REP_CALL, SENIOR_CALL))
    best = F.greatest(e, r, s)
    argmax = (F.when(e == best, F.lit(EMAIL))
              .when(r == best, F.lit(REP_CALL))
              .otherwise(F.lit(SENIOR_CALL)))
    return argmax, best


def best_action(df: DataFrame) -> DataFrame:
    """Argmax channel (first on ties), email fallback, sleeping-dog override."""
    e = F.col(roi_column(EMAIL))
    argmax, best = best_channel()
    dog = F.col("Is_Sleeping_Dog")
    action = (F.when(dog, F.lit(SLEEPING_DOG))
              .when(best.isNull(), F.lit(UNSCORED))
              .when(best > F.lit(0.0), argmax)
              .otherwise(F.lit(EMAIL)))
    roi = (F.when(dog, F.lit(0.0))
           .when(best > F.lit(0.0), best)
           .otherwise(e))
    return df.withColumn("Recommended_Action", action).withColumn("Net_ROI", roi)


def expected_value_saved(df: DataFrame) -> DataFrame:
    """Value at stake times save probability, 0 for sleeping dogs."""
    return df.withColumn(
        "Expected_Value_Saved",
        F.when(F.col("Is_Sleeping_Dog"), F.lit(0.0))
        .otherwise(F.col("Value_At_Stake") * F.col("Save_Prob")))


def at_risk_flag() -> Column:
    return F.col(RISK) > F.lit(AT_RISK)


def decide(df: DataFrame, margin: float | Column = DEFAULT_MARGIN, costs: Costs = Costs(),
           effectiveness=None) -> DataFrame:
    """D1-D6 in one chain: value, save probability, dogs, channel ROI, action."""
    return (df.transform(lambda d: account_value(d, margin))
            .transform(save_probability)
            .transform(sleeping_dogs)
            .transform(lambda d: channel_roi(d, costs, effectiveness))
            .transform(best_action)
            .transform(expected_value_saved))


def decide_scenarios(df: DataFrame, scenarios=SCENARIOS, costs: Costs = Costs(),
                     effectiveness=None) -> DataFrame:
    """Every member under every margin scenario (J1 without a join)."""
    return decide(with_scenarios(df, scenarios), F.col("margin"), costs, effectiveness)
