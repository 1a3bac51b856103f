"""The forest as a node table: equal to the model, and scored again by DuckDB from the same rows."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from retentio.constants import FEATURES
from retentio.operators import forest, learn

TREES, DEPTH = 12, 6


@pytest.fixture(scope="module")
def fitted(spark, members_small):
    # a member without some values, and one beyond all thresholds
    odd = members_small.withColumn("Credit_Limit", F.when(F.col("member_key") % 7 == 0, None).otherwise(F.col("Credit_Limit"))) \
        .withColumn("Total_Trans_Amt", F.when(F.col("member_key") % 11 == 0, float("inf")).otherwise(F.col("Total_Trans_Amt")))
    t = learn.train_and_evaluate(members_small, trees=TREES, depth=DEPTH)
    return t, forest.node_table(t.model).cache(), odd.cache()


def test_node_scores_equal_the_model(fitted):
    t, nodes, members = fitted
    want = {r.member_key: r for r in learn.score_population(t.model, members).collect()}
    got = forest.score_by_nodes(members, nodes, TREES, DEPTH).collect()
    assert len(got) == len(want) == members.count()
    for r in got:
        assert r.Churn_Risk_Score == pytest.approx(want[r.member_key].Churn_Risk_Score, abs=1e-12)
        assert r.prediction == want[r.member_key].prediction


def test_node_scores_equal_sql_on_the_same_table(fitted):
    t, nodes, members = fitted
    con = duckdb.connect()
    tables = {"nodes": nodes.toPandas(), "members": members.select("member_key", *FEATURES).toPandas()}
    for name, frame in tables.items():
        con.register(name, frame)
    values = " ".join(f"when '{f}' then m.\"{f}\"" for f in FEATURES)
    sql = f"""
        with recursive walk as (
            select member_key, tree, 0 as at from members, (select distinct tree from nodes)
            union all
            select w.member_key, w.tree, case when coalesce(case n.feature {values} end, 'nan'::double) <= n.threshold
                                              then n."left" else n."right" end
            from walk w join nodes n on n.tree = w.tree and n.node = w.at join members m using (member_key)
            where n.feature is not null)
        select member_key, avg(n.p_churn) as risk from walk w join nodes n on n.tree = w.tree and n.node = w.at
        where n.feature is null group by member_key"""
    want = dict(con.execute(sql).fetchall())
    got = forest.score_by_nodes(members, nodes, TREES, DEPTH).collect()
    assert len(want) == len(got)
    assert all(r.Churn_Risk_Score == pytest.approx(want[r.member_key], abs=1e-12) for r in got)


def test_importances_equal_the_model(fitted):
    t, nodes, _ = fitted
    got = [(r.feature, r.importance) for r in forest.importances_by_nodes(nodes).collect()]
    want = [(r.feature, r.importance) for r in learn.importances(t.model).collect()]
    assert [f for f, _ in got] == [f for f, _ in want]
    assert [v for _, v in got] == pytest.approx([v for _, v in want], abs=1e-12)


def test_walk_shuffles_only_the_votes(fitted):
    from retentio.session import materialize
    _, nodes, members = fitted
    nodes, members = materialize(nodes, "table"), materialize(members, "table")
    plan = forest.score_by_nodes(members, nodes, TREES, DEPTH)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("BroadcastHashJoin") == DEPTH + 1
