"""A fitted forest as a table of nodes: scoring and importances as plain joins and aggregates.

``node_table`` reads the trees of a fitted model back as rows (tree, node,
feature, threshold, left, right, votes), so that any SQL engine can score the
same members from the same table (``tests/test_forest.py`` does so).  Its size
is set by the model's parameters (trees and depth), not by the members.

``score_by_nodes`` walks all trees at once: one row a member and tree, one
broadcast join a level, then one aggregate a member, which folds a member's
trees before the shuffle.  Votes are summed as decimals, so a retried task
gives the same score.
"""

from __future__ import annotations

import uuid

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentio.constants import FEATURES
from retentio.session import ensure_checkpoint_dir

VOTE = "decimal(20,18)"
BROADCAST_NODES = 2_000_000  # trees of a larger model are joined as the optimizer sees fit


def node_table(model: RandomForestClassificationModel, features=FEATURES) -> DataFrame:
    """One row a node.  ``feature`` (name), ``threshold``, ``left`` and ``right`` are null in leaves;
    values of at most the threshold go left.  ``p_churn`` is the node's share of class 1 by weight,
    ``weight`` its weighted rows and ``gain`` the impurity its split removes.
    """
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/retentio-tables/{spark.sparkContext.applicationId}/forest-{uuid.uuid4().hex}"
    model.write().save(path)
    saved = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    inner = F.col("leftChild") >= 0
    names = F.array(*[F.lit(f) for f in features])
    total = F.aggregate("impurityStats", F.lit(0.0), lambda s, x: s + x)
    return saved.select(
        "tree", F.col("id").alias("node"),
        F.when(inner, F.get(names, F.col("split.featureIndex"))).alias("feature"),
        F.when(inner, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        F.when(inner, F.col("leftChild")).alias("left"), F.when(inner, F.col("rightChild")).alias("right"),
        F.try_divide(F.get("impurityStats", F.lit(1)), total).alias("p_churn"),
        total.alias("weight"), F.when(inner, F.col("gain")).alias("gain"))


def score_by_nodes(members: DataFrame, nodes: DataFrame, trees: int, depth: int, key: str = "member_key",
                   features=FEATURES, col: str = "Churn_Risk_Score") -> DataFrame:
    """(key, prediction, risk) of every member, equal to the model's own scores.

    A missing feature value goes right at every split, as in the model.  Keys
    must be unique: rows that share a key are scored as one.
    """
    number = {f: i for i, f in enumerate(features)}
    of = F.col("feature")
    slim = nodes.select("tree", F.col("node").alias("at"),
                        F.element_at(F.create_map(*[F.lit(x) for pair in number.items() for x in pair]), of).alias("f"),
                        "threshold", "left", "right", F.col("p_churn").cast(VOTE).alias("vote"))
    if trees * 2 ** (depth + 1) <= BROADCAST_NODES:
        slim = F.broadcast(slim)
    values = F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(float("nan"))) for f in features])
    walk = members.select(key, values.alias("x"), F.explode(F.sequence(F.lit(0), F.lit(int(trees) - 1))).alias("tree"),
                          F.lit(0).alias("at"))
    for _ in range(int(depth)):
        step = F.when(F.get("x", F.col("f")) <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        walk = (walk.join(slim.drop("vote"), ["tree", "at"])
                .select(key, "x", "tree", F.coalesce(step, F.col("at")).alias("at")))
    votes = (walk.join(slim.select("tree", "at", "vote"), ["tree", "at"])
             .groupBy(key).agg(F.sum("vote").alias("yes"), F.sum(F.lit(1).cast(VOTE) - F.col("vote")).alias("no")))
    risk = F.col("yes").cast("double") / (F.col("yes") + F.col("no")).cast("double")
    return votes.select(key, F.when(F.col("yes") > F.col("no"), F.lit(1.0)).otherwise(F.lit(0.0)).alias("prediction"),
                        risk.alias(col))


def importances_by_nodes(nodes: DataFrame, features=FEATURES) -> DataFrame:
    """(feature, importance) of every input column, largest first, ties in input order.

    A split's importance is its gain times its weight; trees count alike, and
    the importances add up to 1.
    """
    spark = nodes.sparkSession
    gains = nodes.where("feature IS NOT NULL").groupBy("tree", "feature").agg(
        F.sum(F.col("gain") * F.col("weight")).alias("g"))
    tree = gains.groupBy("tree").agg(F.sum("g").alias("of_tree"))
    # a row a feature and tree: sizes set by the model's parameters
    shares = (gains.join(tree, "tree").groupBy("feature")
              .agg(F.sum(F.try_divide("g", "of_tree")).alias("s")))
    names = spark.range(1).select(F.posexplode(F.array(*[F.lit(f) for f in features])).alias("position", "feature"))
    total = shares.select(F.sum("s")).scalar()
    return (names.join(shares, "feature", "left")
            .select("feature", "position", F.coalesce(F.try_divide(F.col("s"), total), F.lit(0.0)).alias("importance"))
            .orderBy(F.col("importance").desc(), F.col("position")).drop("position"))
