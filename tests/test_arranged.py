"""The forest reads its members in whole rounds of even parts, near rows together, none lost."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from retentio.constants import FEATURES
from retentio.operators import learn
from retentio.plans import catalog
from retentio.session import materialize


def _uneven(spark):
    """Stored rows in one part more than the cores, the last one small; keys repeat and some are null."""
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(0, 400 * cores, 1, cores).unionAll(spark.range(400 * cores, 400 * cores + 20, 1, 1))
    return rows.select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 1000).alias("member_key"),
        *[((F.col("id") * (k + 3) * 7919) % 101).cast("double").alias(f) for k, f in enumerate(FEATURES)],
        (F.col("id") % 3 == 0).cast("int").alias(learn.LABEL))


def _parts(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


@pytest.mark.parametrize("how", ["table", "checkpoint"])
def test_members_of_the_model_are_dealt_evenly(spark, monkeypatch, how):
    cores = spark.sparkContext.defaultParallelism
    stored = materialize(_uneven(spark), "checkpoint")
    assert len(_parts(stored)) == cores + 1
    spark.conf.set("spark.retentio.materialize", how)
    monkeypatch.setattr(catalog, "_members_for", lambda spark, sf, how: stored)
    monkeypatch.setattr(catalog, "_MODELS", {})
    monkeypatch.setattr(learn, "train_and_evaluate", lambda members: None)
    try:
        got = catalog._trained_members(spark, "rows of this test")
    finally:
        spark.conf.unset("spark.retentio.materialize")
    parts = _parts(got)
    assert len(parts) % cores == 0 and max(parts) - min(parts) <= cores + 1 + 20
    assert got.exceptAll(stored).isEmpty() and stored.exceptAll(got).isEmpty()


def test_near_rows_stand_together(spark):
    got = learn.arranged(materialize(_uneven(spark), "checkpoint"), "checkpoint")
    for part in got.select(*learn.NEAR).rdd.glom().collect():
        assert [tuple(r) for r in part] == sorted(tuple(r) for r in part)


def test_one_part_or_a_lazy_table_stays(spark):
    one = materialize(_uneven(spark).coalesce(1), "checkpoint")
    assert learn.arranged(one, "checkpoint") is one
    lazy = _uneven(spark)
    assert learn.arranged(lazy, "none") is lazy and learn.arranged(lazy, "persist") is lazy
