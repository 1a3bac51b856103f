"""The metrics queries score the held-out rows once."""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import functions as F

from retentio.constants import FEATURES
from retentio.operators import learn
from retentio.plans import catalog


def test_held_out_rows_are_scored_once(spark, monkeypatch):
    rows = spark.range(400).select(
        F.col("id").alias("member_key"),
        *[((F.col("id") * (k + 3) * 7919) % 101).cast("double").alias(f) for k, f in enumerate(FEATURES)])
    rows = rows.withColumn(learn.LABEL, ((F.col(FEATURES[0]) + F.col(FEATURES[1])) > 110).cast("int"))
    fitted = learn.train_and_evaluate(rows, trees=5, depth=3)
    want = learn.metrics_table(fitted.predictions, fitted.model).collect()
    plans, plain = [], catalog.materialize

    def seen(df, how=None):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return plain(df, how)

    monkeypatch.setattr(catalog, "materialize", seen)
    monkeypatch.setattr(catalog, "trained", lambda spark, sf: SimpleNamespace(
        predictions=fitted.predictions, model=fitted.model))
    got = catalog._metrics(spark, "rows of this test")
    assert sum(p.count("UDF(features") for p in plans) == 1
    assert got.collect() == want and want[0]["test_set_size"] > 0
