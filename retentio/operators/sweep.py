"""Risk/value weight sweep under a capacity limit (D9) and its optimum.

For every scenario and weight w in 0, step, ..., 100 the members are ranked
by ``priority(w)``; the top ``capacity`` rows give the captured ROI and the
number of at-risk members reached.  Plan: weights come from a generator, the
top-K is ``row_number() <= K`` over (scenario, w) ordered by (priority desc,
member_key), which Catalyst turns into a partial WindowGroupLimit before the
shuffle (each task ships at most K rows per group) and a final one after it.

Before the fan-out, rows that can reach no top-K are dropped by a K-skyband
(``skyband``).  A priority is a mix of two numbers, risk and value after the
loyalty factor, so a row that K rows beat in both is in no top-K at any
weight.  Beaters are counted on a grid: the cuts are tail quantiles (any cuts
give exact results), each cut value is a cell of its own, and rows are
counted a cell - a summary that merges by addition and holds at most
(2 * cuts + 1)^2 cells a scenario.  Sums over the cells above and right of a
cell then bound the beaters of all its rows from below.  Only cells that are
surely apart count (``APART`` is far above any rounding of a priority), so
rows that tie with others are kept and ties are cut by key as always.  At the
ends, weights 0 and 100, one of the two numbers alone decides; a row that can
only win there is fanned out to that end alone.

The top-K itself has two stages: K rows per (scenario, weight, salt), then K
per (scenario, weight), so that no task sorts a whole group.  While K is at
most ``spark.sql.optimizer.windowGroupLimitThreshold`` (1000 by default)
Catalyst also cuts each task's share to K rows before the shuffle; for larger
K a session may raise it, the results don't depend on it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retentio.constants import DEFAULT_CAPACITY, OBJECTIVE_EPS, WEIGHT_STEP
from retentio.functions.cuts import blocked, cell, constant_rows
from retentio.functions.scalar import round_even
from retentio.operators.decide import RISK, at_risk_flag
from retentio.operators.population import priority_expr
from retentio.operators.rank import top_k_per_group

GROUP = ("Scenario",)
SWEEP_COLUMNS = ("member_key", RISK, "Normalized_Value", "Loyalty_Weight", "Is_Sleeping_Dog", "Net_ROI")
# Quantiles that cut the grid: tails of 2^0 to 2^-12, three an octave.
TAIL_LEVELS = tuple(1.0 - 2.0 ** (-k / 3) for k in range(37))
QUANTILE_ACCURACY = 20_000
# Least relative distance of two cuts: priorities round to about 1e-15.
APART = 1e-9


def _weights(step: int):
    return F.sequence(F.lit(0), F.lit(100), F.lit(int(step)))


def weight_priorities(df: DataFrame, group_cols, step: int) -> DataFrame:
    """One row per member and weight w in 0, step, ..., 100, with its priority ``p``."""
    x = df.select(*group_cols, *SWEEP_COLUMNS, F.explode(_weights(step)).alias("w"))
    return x.withColumn("p", priority_expr(F.col("w")))


def top_rows(x: DataFrame, capacity: int, group_cols) -> DataFrame:
    """The first ``capacity`` scored rows of every (group, weight), with position ``rn``."""
    return top_k_per_group(x.filter(F.col("p").isNotNull()), [*group_cols, "w"],
                           [F.col("p").desc(), F.col("member_key")], capacity)


def _pair(df: DataFrame, group_cols) -> DataFrame:
    """Scored rows with the two numbers that a priority mixes: ``_a`` (weight 100) and ``_b`` (weight 0)."""
    base = df.select(*group_cols, *SWEEP_COLUMNS)

    def side(c):
        return F.when(F.col("Is_Sleeping_Dog"), F.lit(-1.0)).otherwise(F.col(c) * F.col("Loyalty_Weight"))

    return base.withColumns({"_a": side(RISK), "_b": side("Normalized_Value")}).filter(
        F.col("_a").isNotNull() & F.col("_b").isNotNull())


def _cuts(pairs: DataFrame, group_cols) -> DataFrame:
    """Per group the cut values of both numbers, ascending and ``APART`` from each other."""
    levels = F.array(*[F.lit(x) for x in TAIL_LEVELS])
    size = F.lit(1.0) + F.max(F.abs("_a")) + F.max(F.abs("_b"))
    found = pairs.groupBy(*group_cols).agg(
        *[F.percentile_approx(c, levels, QUANTILE_ACCURACY).alias(c) for c in ("_a", "_b")], size.alias("_size"))

    def spaced(c):
        own = F.array_sort(F.array_distinct(c))
        before = F.transform(own, lambda x, i: F.struct(x.alias("x"), F.when(i > 0, F.get(own, i - 1)).alias("last")))
        far = F.filter(before, lambda s: s["last"].isNull() | (s["x"] - s["last"] >= F.lit(APART) * F.col("_size")))
        return F.transform(far, lambda s: s["x"])

    return found.select(*group_cols, blocked(spaced("_a")).alias("_cuts_a"), blocked(spaced("_b")).alias("_cuts_b"))


def beaten(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows that surely beat all rows of each cell of ``counts`` (i, j): at weight 0, between, at weight 100.

    A cell's even number names an open interval, an odd one a single value.
    Values of cell x' are at least those of x if x' > x, or x' = x is odd; they
    are surely larger (by a whole interval) if x' >= x + 3, or x + 2 for odd x.
    Rows of (i', j') beat all rows of (i, j) between the ends if they are at
    least as large in both numbers and surely larger in one.
    """
    n, m = counts.shape
    above = np.zeros((n + 4, m + 4), dtype=np.int64)  # rows of cells (i', j') with i' >= i and j' >= j
    above[:n, :m] = counts[::-1, ::-1].cumsum(axis=0).cumsum(axis=1)[::-1, ::-1]
    i, j = np.arange(n)[:, None], np.arange(m)[None, :]
    weak = lambda x: x + 1 - x % 2
    sure = lambda x: x + 3 - x % 2
    between = above[weak(i), sure(j)] + above[sure(i), weak(j)] - above[sure(i), sure(j)]
    return above[0 * i, sure(j)] + 0 * i, between, above[sure(i), 0 * j] + 0 * j


def skyband(df: DataFrame, capacity: int, group_cols=GROUP) -> DataFrame:
    """Rows that can reach a top-K, with ``_ends``: bit 1 at weight 0, 2 between the ends, 4 at weight 100.

    Runs two jobs over ``df``: the cut values, and the counts a cell.  The
    driver sees a row a group and the cells, a number set by the cuts alone.
    """
    group_cols = list(group_cols)
    spark = df.sparkSession
    pairs = _pair(df, group_cols)
    cuts = _cuts(pairs, group_cols)
    schema, held = cuts.schema, [r.asDict(recursive=True) for r in cuts.collect()]

    def placed(table: DataFrame) -> DataFrame:
        # one row a group of the parameter list: bounded broadcast
        return pairs.join(F.broadcast(table), group_cols).withColumns(
            {"_i": cell(F.col("_a"), "_cuts_a"), "_j": cell(F.col("_b"), "_cuts_b")}).drop("_cuts_a", "_cuts_b")

    counted = placed(constant_rows(spark, held, schema)).groupBy(*group_cols, "_i", "_j").count().collect()
    side = 2 * len(TAIL_LEVELS) + 1
    grids = {tuple(r[g] for g in group_cols): np.zeros((side, side), dtype=np.int64) for r in held}
    for r in counted:
        grids[tuple(r[g] for g in group_cols)][r["_i"], r["_j"]] = r["count"]
    rows = []
    for r in held:
        low, between, high = (b < capacity for b in beaten(grids[tuple(r[g] for g in group_cols)]))
        rows.append({**r, "_flags": (low * 1 + between * 2 + high * 4).reshape(-1).tolist()})
    ends = T.StructType([*schema.fields, T.StructField("_flags", T.ArrayType(T.IntegerType()))])
    found = placed(constant_rows(spark, rows, ends)).withColumn("_ends", F.get("_flags", F.col("_i") * side + F.col("_j")))
    return found.filter(F.col("_ends") > 0).drop("_i", "_j", "_a", "_b", "_flags")


def pruned_priorities(df: DataFrame, capacity: int, step: int = WEIGHT_STEP, group_cols=GROUP,
                      prune: bool = True) -> DataFrame:
    """Rows of ``weight_priorities`` that can reach a top-K (all that do are there)."""
    group_cols = list(group_cols)
    if not prune or not group_cols:
        return weight_priorities(df, group_cols, step)
    none = F.array().cast("array<int>")
    every = range(0, 101, int(step))
    ends = {1: [w for w in every if w == 0], 2: [w for w in every if 0 < w < 100], 4: [w for w in every if w == 100]}
    weights = F.concat(*[F.when(F.col("_ends").bitwiseAND(bit) > 0, F.array(*map(F.lit, ws)).cast("array<int>"))
                         .otherwise(none) for bit, ws in ends.items()])
    x = skyband(df, capacity, group_cols).select(*group_cols, *SWEEP_COLUMNS, F.explode(weights).alias("w"))
    return x.withColumn("p", priority_expr(F.col("w")))


def tradeoff_curve(df: DataFrame, capacity: int = DEFAULT_CAPACITY, step: int = WEIGHT_STEP,
                   group_cols=GROUP, fraction: float = 1.0) -> DataFrame:
    """One row per (scenario, weight): captured ROI and at-risk members reached.

    ``fraction`` 0 ranks all rows at all weights, without the skyband.

    ROI is summed as decimal, so equal top-K sets give equal sums whatever the
    summation order; it is reported as a double rounded to 4 places.
    """
    group_cols = list(group_cols)
    top = top_rows(pruned_priorities(df, capacity, step, group_cols, fraction > 0), capacity, group_cols)
    return (top.groupBy(*group_cols, F.col("w").cast("int").alias("Risk_Weight_Pct"))
            .agg(F.sum(F.col("Net_ROI").cast("decimal(38,8)")).alias("_roi"),
                 F.count_if(at_risk_flag()).cast("long").alias("At_Risk_Reached"))
            .select(*group_cols, "Risk_Weight_Pct",
                    round_even(F.col("_roi").cast("double"), 4).alias("Captured_Net_ROI"),
                    "At_Risk_Reached"))


def with_objective(curve: DataFrame, group_cols=GROUP) -> DataFrame:
    """0.5 * minmax(ROI) + 0.5 * minmax(reached), per group.

    The curve has a fixed number of rows per group (one per weight), so the
    window over a group is small by construction.
    """
    w = Window.partitionBy(*group_cols)

    def mm(c):
        return (F.col(c) - F.min(c).over(w)) / (F.max(c).over(w) - F.min(c).over(w) + F.lit(OBJECTIVE_EPS))

    return curve.withColumn("Objective", F.lit(0.5) * mm("Captured_Net_ROI")
                            + F.lit(0.5) * mm("At_Risk_Reached"))


def optimal_weight(curve: DataFrame, group_cols=GROUP) -> DataFrame:
    """The weight with the best objective, lowest weight on ties."""
    obj = with_objective(curve, group_cols)
    return obj.groupBy(*group_cols).agg(
        F.max_by(F.col("Risk_Weight_Pct"),
                 F.struct(F.col("Objective"), -F.col("Risk_Weight_Pct"))).alias("Optimal_Risk_Weight_Pct"),
        F.max("Objective").alias("Best_Objective"))
