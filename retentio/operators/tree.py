"""One class-weighted decision tree by distributed split histograms, without sampling.

Every value can be checked: cuts, splits, gains and importances are functions
of the training rows alone, whatever their order and partitions.  Each level
is one aggregate: rows are counted by (node, feature, bin, class), which
folds in the tasks to at most nodes x features x bins rows, running sums over
the bins give the Gini gain of every cut, and the best cut of each node goes
to the driver - as many rows as the level has nodes.

Counts are whole numbers and are weighted after they are summed.  Ties go to
the earlier feature, then to the lower cut.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retentio.constants import FEATURES
from retentio.functions.cuts import constant_rows
from retentio.session import materialize

TREE_DEPTH = 4
TREE_BINS = 32
NODE_SCHEMA = T.StructType([
    T.StructField("node", T.LongType()), T.StructField("feature", T.StringType()),
    T.StructField("threshold", T.DoubleType()), T.StructField("gain", T.DoubleType()),
    T.StructField("pos", T.LongType()), T.StructField("neg", T.LongType()),
    T.StructField("weight", T.DoubleType()), T.StructField("p_churn", T.DoubleType())])


def width_cuts(train: DataFrame, features=FEATURES, bins: int = TREE_BINS) -> list[list[float]]:
    """Cuts of equal width between each feature's least and greatest value."""
    row = train.agg(*[f(F.col(c).cast("double")) for c in features for f in (F.min, F.max)]).first()
    out = []
    for lo, hi in zip(row[::2], row[1::2]):
        out.append(sorted({lo + (hi - lo) * k / bins for k in range(1, bins)}) if lo is not None else [])
    return out


def quantile_cuts(train: DataFrame, features=FEATURES, bins: int = TREE_BINS) -> list[list[float]]:
    """Cuts at approximate quantiles of each feature (fewer where values repeat)."""
    levels = F.array(*[F.lit(k / bins) for k in range(1, bins)])
    row = train.agg(*[F.percentile_approx(F.col(c).cast("double"), levels, 10_000) for c in features]).first()
    return [sorted(set(c or [])) for c in row]


def _constant(value, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(value)), kind)


def _impurity(p: Column, n: Column) -> Column:
    t = p + n
    return F.lit(1.0) - (p / t) * (p / t) - (n / t) * (n / t)


def fit_tree(train: DataFrame, features=FEATURES, label: str = "Churn_Flag", depth: int = TREE_DEPTH,
             cuts: list[list[float]] | None = None, bins: int = TREE_BINS, weighted: bool = True,
             how: str | None = None) -> DataFrame:
    """The tree's nodes (root 1, children 2i and 2i + 1): split, gain, class counts, weight, share of churn.

    ``feature``, ``threshold`` and ``gain`` are null in leaves; values of at
    most the threshold go left, others and missing ones right.  A node is
    split where both sides get rows and the gain is above 0.
    """
    cuts = width_cuts(train, features, bins) if cuts is None else cuts
    held = _constant(cuts, "array<array<double>>")
    values = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in features])
    binned = F.zip_with(values, held, lambda x, own: F.size(F.filter(own, lambda c: c < x)))
    rows = materialize(train.select(binned.alias("bins"), F.col(label).alias("y")).filter(F.col("y").isin(0, 1)), how)
    n = rows.agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg")).first()
    total = n["pos"] + n["neg"]
    w_pos, w_neg = ((total / (2.0 * c) if c else 0.0) if weighted else 1.0 for c in (n["pos"], n["neg"]))
    nodes: dict[int, dict] = {1: {"pos": n["pos"], "neg": n["neg"]}} if total else {}
    placed = rows.withColumn("node", F.lit(1).cast("long"))
    for level in range(int(depth)):
        open_ = [i for i in nodes if i >= 2 ** level and nodes[i]["pos"] and nodes[i]["neg"]]
        if not open_:
            break
        best = _best_splits(placed.filter(F.col("node").isin(open_)), w_pos, w_neg).collect()
        splits = {}
        for r in best:  # at most one row a node of the level
            i, f = r["node"], r["f"]
            nodes[i].update(feature=features[f], threshold=cuts[f][r["bin"]], gain=r["gain"])
            nodes[2 * i] = {"pos": r["lp"], "neg": r["ln"]}
            nodes[2 * i + 1] = {"pos": r["p"] - r["lp"], "neg": r["n"] - r["ln"]}
            splits[str(i)] = {"f": f, "bin": r["bin"]}
        if not splits:
            break
        own = F.element_at(_constant(splits, "map<string, struct<f: int, bin: int>>"), F.col("node").cast("string"))
        left = F.get("bins", own["f"]) <= own["bin"]
        placed = placed.withColumn("node", F.when(own.isNull(), F.col("node")).when(left, 2 * F.col("node"))
                                   .otherwise(2 * F.col("node") + 1))
    out = []
    for i, v in sorted(nodes.items()):
        p, q = v["pos"] * w_pos, v["neg"] * w_neg
        out.append({"node": i, "feature": None, "threshold": None, "gain": None, **v, "weight": p + q,
                    "p_churn": p / (p + q)})
    return constant_rows(train.sparkSession, out, NODE_SCHEMA)


def _best_splits(placed: DataFrame, w_pos: float, w_neg: float) -> DataFrame:
    """(node, f, bin, gain, lp, ln, p, n): the best cut of each node; rows of bins up to ``bin`` go left."""
    counts = (placed.select("node", "y", F.posexplode("bins").alias("f", "bin"))
              .groupBy("node", "f", "bin")
              .agg(F.count_if(F.col("y") == 1).alias("cp"), F.count_if(F.col("y") == 0).alias("cn")))
    upto = Window.partitionBy("node", "f").orderBy("bin")
    of_node = Window.partitionBy("node", "f")
    sums = counts.select("node", "f", "bin", F.sum("cp").over(upto).alias("lp"), F.sum("cn").over(upto).alias("ln"),
                         F.sum("cp").over(of_node).alias("p"), F.sum("cn").over(of_node).alias("n"))
    sums = sums.filter(F.col("lp") + F.col("ln") < F.col("p") + F.col("n"))  # both sides get rows
    lp, ln = F.col("lp") * F.lit(w_pos), F.col("ln") * F.lit(w_neg)
    rp, rn = (F.col("p") - F.col("lp")) * F.lit(w_pos), (F.col("n") - F.col("ln")) * F.lit(w_neg)
    p, n = F.col("p") * F.lit(w_pos), F.col("n") * F.lit(w_neg)
    t = p + n
    gain = _impurity(p, n) - (lp + ln) / t * _impurity(lp, ln) - (rp + rn) / t * _impurity(rp, rn)
    # equal gains may differ in their last bits: compared to 12 places
    gains = sums.withColumn("gain", F.rint(gain * F.lit(1e12)) / F.lit(1e12)).filter(F.col("gain") > 0)
    first = F.max_by(F.struct("f", "bin", "gain", "lp", "ln", "p", "n"),
                     F.struct(F.col("gain"), -F.col("f"), -F.col("bin")))
    return gains.groupBy("node").agg(first.alias("b")).select("node", "b.*")


def tree_importances(nodes: DataFrame, features=FEATURES) -> DataFrame:
    """(feature, importance): gain times weight of each feature's splits, adding up to 1; largest first."""
    names = nodes.sparkSession.range(1).select(
        F.posexplode(F.array(*[F.lit(f) for f in features])).alias("position", "feature"))
    own = nodes.filter(F.col("feature").isNotNull()).groupBy("feature").agg(
        F.sum(F.col("gain") * F.col("weight")).alias("g"))
    total = own.select(F.sum("g")).scalar()
    return (names.join(own, "feature", "left")
            .select("feature", "position", F.coalesce(F.try_divide(F.col("g"), total), F.lit(0.0)).alias("importance"))
            .orderBy(F.col("importance").desc(), F.col("position")).drop("position"))


def tree_scores(members: DataFrame, nodes: DataFrame, depth: int = TREE_DEPTH, features=FEATURES,
                col: str = "Churn_Risk_Score") -> DataFrame:
    """Members with ``node`` (the leaf they fall into), ``prediction`` and their leaf's share of churn.

    The nodes, at most 2^(depth + 1), are one constant map; the walk is row-local.
    """
    number = F.create_map(*[F.lit(x) for pair in zip(features, range(len(features))) for x in pair])
    tree = nodes.agg(F.map_from_entries(F.collect_list(F.struct("node", F.struct(
        F.element_at(number, F.col("feature")).alias("f"), "threshold", "p_churn")))).alias("m")).scalar()
    values = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in features])
    walked = members.withColumns({"_x": values, "_tree": tree, "node": F.lit(1).cast("long")})
    for _ in range(int(depth)):
        at = F.element_at("_tree", F.col("node"))
        walked = walked.withColumn("node", F.when(at["f"].isNull(), F.col("node"))
                                   .when(F.get("_x", at["f"]) <= at["threshold"], 2 * F.col("node"))
                                   .otherwise(2 * F.col("node") + 1))
    risk = F.element_at("_tree", F.col("node"))["p_churn"]
    return (walked.withColumns({col: risk, "prediction": F.when(risk > 0.5, F.lit(1.0)).otherwise(F.lit(0.0))})
            .drop("_x", "_tree"))
