"""Churn model: features, split, class-weighted random forest, evaluation, scoring.

All steps are MLlib/DataFrame jobs; scored members stay distributed.  The
confusion counts come from one aggregate (not one job per cell).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retentio.constants import FEATURES, RF_DEPTH, RF_TREES, SEED, TEST_FRACTION
from retentio.functions.scalar import round_even
from retentio.session import default_materialize, materialize

LABEL = "Churn_Flag"

METRICS_SCHEMA = T.StructType([
    T.StructField("roc_auc", T.DoubleType()),
    T.StructField("pr_auc", T.DoubleType()),
    T.StructField("accuracy", T.DoubleType()),
    T.StructField("f1", T.DoubleType()),
    T.StructField("precision", T.DoubleType()),
    T.StructField("recall", T.DoubleType()),
    T.StructField("confusion", T.StructType([
        T.StructField("tp", T.LongType()), T.StructField("fp", T.LongType()),
        T.StructField("fn", T.LongType()), T.StructField("tn", T.LongType())])),
    T.StructField("top_features", T.ArrayType(T.StructType([
        T.StructField("feature", T.StringType()), T.StructField("importance", T.DoubleType())]))),
    T.StructField("test_set_size", T.LongType()),
])


def index_tier(df: DataFrame, input_col: str = "Card_Category",
               output_col: str = "Card_Tier_Index") -> DataFrame:
    """L1: string index (frequency order); unseen values get an extra index."""
    model = StringIndexer(inputCol=input_col, outputCol=output_col, handleInvalid="keep").fit(df)
    return model.transform(df)


def assemble(df: DataFrame, features=FEATURES, output_col: str = "features") -> DataFrame:
    """L2: the 12 behaviour columns as one vector."""
    return VectorAssembler(inputCols=list(features), outputCol=output_col,
                           handleInvalid="keep").transform(df)


NEAR = ("Months_Inactive_12_mon", "Total_Trans_Ct", "Total_Relationship_Count", "Contacts_Count_12_mon",
        "Months_on_book", "Total_Trans_Amt")


def arranged(members: DataFrame, how: str | None = None) -> DataFrame:
    """A stored member table, stored again for the forest: all rows, in whole rounds of even parts.

    Every pass of the fit waits for its last task, so the parts are as many as
    the session's cores or a multiple.  Inside a part, rows near in behaviour
    stand together: they reach the same nodes of most trees, whose counts are
    then at hand.  MLlib draws each tree's rows by part and place, so the
    forest depends on the layout, as it does on the stored one.  A table of one
    part, or one that is not stored (``how``), stays as it is.
    """
    how = how or default_materialize(members.sparkSession)
    parts = members.rdd.getNumPartitions() if how in ("table", "checkpoint") else 1
    if parts < 2:
        return members
    cores = members.sparkSession.sparkContext.defaultParallelism
    return materialize(members.repartition(cores * -(-parts // cores)).sortWithinPartitions(*NEAR), how)


def test_flag(key: str = "member_key", test_fraction: float = TEST_FRACTION, seed: int = SEED):
    """L3: a member is in the test split by the md5 digest of its key (as text) and the seed.

    Depends only on the key, whatever its type and sign, so it is stable under
    repartitioning and reruns; a null key is in the training split.
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % F.lit(10_000)
    return F.col(key).isNotNull() & (h < F.lit(int(round(test_fraction * 10_000))))


def split(df: DataFrame, test_fraction: float = TEST_FRACTION, seed: int = SEED,
          method: str = "hash") -> tuple[DataFrame, DataFrame]:
    """L3: (train, test).  ``method='random'`` uses ``randomSplit`` instead."""
    if method == "random":
        train, test = df.randomSplit([1.0 - test_fraction, test_fraction], seed=seed)
        return train, test
    flag = test_flag(test_fraction=test_fraction, seed=seed)
    return df.filter(~flag), df.filter(flag)


def class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """A3: one aggregate: n, positives, n/(2*pos), n/(2*neg) (null if a class is empty)."""
    n = F.count("*")
    pos = F.count_if(F.col(label) == 1)
    return df.agg(
        n.cast("long").alias("n"), pos.cast("long").alias("pos"),
        F.try_divide(n.cast("double"), F.lit(2.0) * pos).alias("w_pos"),
        F.try_divide(n.cast("double"), F.lit(2.0) * (n - pos)).alias("w_neg"))


def with_weights(df: DataFrame, weights_from: DataFrame | None = None, label: str = LABEL) -> DataFrame:
    """Class weight on every row, from ``weights_from`` (default: ``df`` itself).

    The two weights come from one aggregate, read as one scalar subquery.
    """
    w = class_weights(weights_from if weights_from is not None else df, label)
    # one scalar subquery (one pass) carrying both weights, referenced once
    both = w.select(F.array("w_neg", "w_pos")).scalar()
    idx = F.when(F.col(label) == 1, F.lit(1)).otherwise(F.lit(0))
    return df.withColumn("weight", both[idx])


def fit_forest(train: DataFrame, trees: int = RF_TREES, depth: int = RF_DEPTH,
               seed: int = SEED, weight_col: str | None = "weight",
               max_memory_mb: int = 1024) -> RandomForestClassificationModel:
    """L4: class-weighted random forest.

    ``max_memory_mb`` is the per-pass histogram budget: a larger budget splits
    more nodes per pass over the data, so deep forests need fewer passes.
    Node ids are cached (and checkpointed in the shared folder) between passes.
    """
    rf = RandomForestClassifier(featuresCol="features", labelCol=LABEL, numTrees=trees,
                                maxDepth=depth, seed=seed, maxMemoryInMB=max_memory_mb,
                                cacheNodeIds=True)
    if weight_col:
        rf = rf.setWeightCol(weight_col)
    return rf.fit(train)


def with_risk(pred: DataFrame, col: str = "Churn_Risk_Score") -> DataFrame:
    """P(churn) from the probability vector."""
    return pred.withColumn(col, vector_to_array(F.col("probability")).getItem(1))


def confusion(pred: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """A4/A5: tp, fp, fn, tn, test size, precision and recall (0.0 if undefined), one pass."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    yn, pn = F.col(label) == 0, F.col(prediction) == 0
    c = pred.agg(F.count_if(y & p).cast("long").alias("tp"),
                 F.count_if(yn & p).cast("long").alias("fp"),
                 F.count_if(y & pn).cast("long").alias("fn"),
                 F.count_if(yn & pn).cast("long").alias("tn"))
    return c.select(
        "tp", "fp", "fn", "tn",
        (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("test_set_size"),
        F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), F.lit(0.0)).alias("recall"),
        F.coalesce(F.try_divide(F.lit(2) * F.col("tp"), F.lit(2) * F.col("tp") + F.col("fp") + F.col("fn")),
                   F.lit(0.0)).alias("churn_f1"))


CURVE_CELLS = 1 << 16  # equal parts of the score's range, the unit of the curve's prefix sums


def curve_counts(pred: DataFrame, label: str = LABEL, score: str | Column = "Churn_Risk_Score",
                 prediction: str = "prediction", top: float = 1.0) -> DataFrame:
    """One row: ``roc_auc``, ``pr_auc`` and the confusion counts, in one lazy pass.

    Rows are counted a distinct score, in cells of the range 0..``top`` (scores
    beyond it share the end cells).  Running sums are taken inside the cells,
    which are spread over the tasks, and started from the sums of the cells
    above, a table of at most ``CURVE_CELLS`` + 1 rows.  The areas are those of
    the trapezoid rule with one point a distinct score: positives against
    negatives from (0, 0) to (1, 1), and precision against recall from recall
    0 at the first precision.  No negatives: ROC area 1; no positives: both 0.
    """
    x = F.col(score) if isinstance(score, str) else score
    cells = F.lit(float(CURVE_CELLS))
    y, p = F.col(label), F.col(prediction)
    rows = pred.select(x.cast("double").alias("_x"), y.alias("_y"), p.alias("_p")).withColumn(
        "_cell", F.floor(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("_x") / F.lit(float(top)))) * cells))
    counts = {"tp": (1, 1), "fp": (0, 1), "fn": (1, 0), "tn": (0, 0)}
    ties = rows.groupBy("_cell", "_x").agg(
        F.count_if(F.col("_y") == 1).alias("_pos"), F.count_if(F.col("_y") == 0).alias("_neg"),
        *[F.count_if((F.col("_y") == a) & (F.col("_p") == b)).alias(n) for n, (a, b) in counts.items()])
    down = Window.partitionBy("_cell").orderBy(F.col("_x").desc())
    ties = ties.withColumns({"_cp": F.sum("_pos").over(down), "_cn": F.sum("_neg").over(down)})
    # a row a cell: bounded by CURVE_CELLS
    totals = rows.groupBy(F.col("_cell").alias("_of")).agg(
        F.count_if(F.col("_y") == 1).alias("_tp"), F.count_if(F.col("_y") == 0).alias("_tn"))
    above = Window.orderBy(F.col("_of").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.col("_of").desc()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0)
    totals = totals.select("_of", F.coalesce(F.sum("_tp").over(above), zero).alias("_bp"),
                           F.coalesce(F.sum("_tn").over(above), zero).alias("_bn"),
                           F.sum("_tp").over(every).alias("_P"), F.sum("_tn").over(every).alias("_N"))
    points = ties.join(totals, F.col("_cell").eqNullSafe(F.col("_of")))
    tp, fp = F.col("_bp") + F.col("_cp"), F.col("_bn") + F.col("_cn")
    points = points.withColumns({"_tp": tp, "_fp": fp}).filter(F.col("_pos") + F.col("_neg") > 0)
    before = F.col("_tp") - F.col("_pos"), F.col("_fp") - F.col("_neg")
    precision = F.col("_tp") / (F.col("_tp") + F.col("_fp"))
    last = F.when(before[0] + before[1] > 0, F.try_divide(before[0], before[0] + before[1])).otherwise(precision)
    exact = "decimal(38,0)"
    roc = F.sum(F.col("_neg").cast("decimal(19,0)") * (before[0] + F.col("_tp")).cast("decimal(19,0)")).cast(exact)
    one = points.agg(
        roc.alias("_roc"), F.sum(F.col("_pos") * (precision + last)).alias("_pr"),
        F.max("_P").alias("_P"), F.max("_N").alias("_N"), *[F.sum(n).alias(n) for n in counts])
    area = F.col("_roc").cast("double") / F.lit(2.0) / F.col("_P").cast("double") / F.col("_N").cast("double")
    some = F.col("_P") > 0
    return one.select(
        F.when(F.col("_N") == 0, F.lit(1.0)).when(some, area).otherwise(F.lit(0.0)).alias("roc_auc"),
        F.when(some, F.col("_pr") / F.lit(2.0) / F.col("_P")).otherwise(F.lit(0.0)).alias("pr_auc"),
        *[F.coalesce(F.col(n), zero).cast("long").alias(n) for n in counts])


def with_count_scores(one: DataFrame) -> DataFrame:
    """Adds test size, precision, recall, both F1 scores and accuracy to rows of tp, fp, fn, tn."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn

    def share(a, b):
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    f1 = share(2 * tp, 2 * tp + fp + fn)
    other = share(2 * tn, 2 * tn + fn + fp)
    return one.withColumns({
        "test_set_size": (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).cast("long"),
        "precision": share(tp, tp + fp), "recall": share(tp, tp + fn), "churn_f1": f1,
        "accuracy": share(tp + tn, n), "f1": share((tp + fn) * f1 + (tn + fp) * other, n)})


def curve_scores(pred: DataFrame, label: str = LABEL, score: str = "rawPrediction",
                 num_bins: int = 0) -> dict[str, float]:
    """L7, L8 by MLlib's evaluator (two passes, run at once); :func:`curve_counts` is the lazy form.

    ``num_bins`` 0 is exact, one point a distinct score; a positive number merges
    neighbouring scores into about that many points.
    """
    def binary(metric):
        return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=score, metricName=metric,
                                             numBins=int(num_bins)).evaluate(pred)

    return {"roc_auc": binary("areaUnderROC"), "pr_auc": binary("areaUnderPR")}


def count_scores(tp: int, fp: int, fn: int, tn: int) -> dict[str, float]:
    """L9, L10 from the confusion counts: accuracy and the class-weighted F1.

    Same definitions as the multiclass evaluator's ``accuracy`` and ``f1``
    (per-class F1 = 2*TP_c / (2*TP_c + FP_c + FN_c), weighted by class
    support), so the one confusion aggregate replaces two more passes.
    """
    n = tp + fp + fn + tn
    if n == 0:
        return {"accuracy": 0.0, "f1": 0.0}

    def f1(t, false_pos, false_neg):
        d = 2 * t + false_pos + false_neg
        return 2 * t / d if d else 0.0

    weighted = ((tp + fn) * f1(tp, fp, fn) + (tn + fp) * f1(tn, fn, fp)) / n
    return {"accuracy": (tp + tn) / n, "f1": weighted}


def _literal_rows(rows: list[dict]) -> DataFrame:
    """A small table of literal rows, built JVM-side (no Python worker)."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    structs = [F.struct(*[F.lit(v).alias(k) for k, v in r.items()]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def importances(model: RandomForestClassificationModel, features=FEATURES) -> DataFrame:
    """(feature, importance) for every input column, largest first; equal
    importances keep the input column order.

    The model holds one number per input column (12 here), so the table is
    small by construction.
    """
    vals = model.featureImportances.toArray().tolist()
    df = _literal_rows([{"position": i, "feature": f, "importance": float(v)}
                        for i, (f, v) in enumerate(zip(features, vals))])
    return df.orderBy(F.col("importance").desc(), F.col("position")).drop("position")


def top_features(imp: DataFrame, n: int = 5) -> DataFrame:
    """The n most important features (``imp`` is already in importance order)."""
    return imp.limit(int(n))


def metrics_table(pred: DataFrame, model: RandomForestClassificationModel, features=FEATURES,
                  places: int = 4) -> DataFrame:
    """One-row metrics document (scores, confusion, top five, test size).

    A lazy plan: one pass over the held-out predictions gives both areas and
    the confusion counts, from which the other scores follow.
    """
    votes = vector_to_array(F.col("rawPrediction")).getItem(1)
    one = with_count_scores(curve_counts(pred, score=votes, top=float(model.getNumTrees)))
    vals = model.featureImportances.toArray().tolist()
    order = sorted(range(len(vals)), key=lambda i: -vals[i])[:5]   # stable: ties keep input order
    top = F.array(*[F.struct(F.lit(features[i]).alias("feature"),
                             round_even(F.lit(float(vals[i])), places).alias("importance")) for i in order])
    scores = ("roc_auc", "pr_auc", "accuracy", "f1", "precision", "recall")
    return one.select(
        *[round_even(c, places).alias(c) for c in scores],
        F.struct("tp", "fp", "fn", "tn").alias("confusion"), top.alias("top_features"),
        "test_set_size", round_even("churn_f1", places).alias("churn_f1"))


def headline(metrics: DataFrame) -> DataFrame:
    """Recall, ROC-AUC and the top feature."""
    return metrics.select("recall", "roc_auc",
                          F.col("top_features").getItem(0).getField("feature").alias("top_feature"))


@dataclass
class TrainedModel:
    model: RandomForestClassificationModel
    train: DataFrame
    test: DataFrame
    predictions: DataFrame


def train_and_evaluate(members: DataFrame, trees: int = RF_TREES, depth: int = RF_DEPTH,
                       seed: int = SEED, test_fraction: float = TEST_FRACTION,
                       split_method: str = "hash", weights_from_full: bool = False) -> TrainedModel:
    """Features -> split -> class weights -> fit -> held-out predictions.

    Class weights come from the training split; ``weights_from_full`` uses the
    whole table before the split instead.
    """
    data = assemble(members)   # the tier index (L1) is not a model input
    train, test = split(data, test_fraction, seed, split_method)
    src = data if weights_from_full else train
    train = with_weights(train, src)
    model = fit_forest(train, trees, depth, seed)
    pred = model.transform(test)
    return TrainedModel(model, train, test, pred)


SCORED_COLUMNS = FEATURES + ("Card_Category", LABEL, "prediction", "Churn_Risk_Score")


def score_population(model: RandomForestClassificationModel, members: DataFrame,
                     keep_key: bool = True) -> DataFrame:
    """Score every member; export columns plus risk (stays distributed).

    ``is_train`` marks rows of the hash split's training side, since
    full-population scores include rows the model saw.
    """
    data = assemble(members)
    pred = with_risk(model.transform(data))
    cols = (["member_key"] if keep_key else []) + list(SCORED_COLUMNS)
    return pred.select(*cols, (~test_flag()).alias("is_train"))
