"""The single tree against a plain NumPy tree."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from retentio.constants import FEATURES
from retentio.operators import tree


def plain_tree(x, y, cuts, depth, weighted=True):
    n = len(y)
    w = np.where(y == 1, n / (2 * max(1, (y == 1).sum())), n / (2 * max(1, (y == 0).sum()))) if weighted else np.ones(n)

    def impurity(rows):
        t = w[rows].sum()
        return 1 - sum((w[rows & (y == c)].sum() / t) ** 2 for c in (0, 1))

    out, todo = {}, [(1, np.ones(n, bool), 0)]
    while todo:
        node, rows, level = todo.pop()
        out[node] = [None, None, None, int((rows & (y == 1)).sum()), int((rows & (y == 0)).sum())]
        best = None
        for f in range(x.shape[1]) if level < depth else ():
            for c in cuts[f]:
                left = rows & (x[:, f] <= c)
                right = rows & ~left
                if left.any() and right.any():
                    t = w[rows].sum()
                    gain = impurity(rows) - w[left].sum() / t * impurity(left) - w[right].sum() / t * impurity(right)
                    if gain > 1e-11 and (best is None or gain > best[0] + 1e-11):
                        best = (gain, f, c, left, right)
        if best:
            out[node][:3] = [FEATURES[best[1]], best[2], best[0]]
            todo += [(2 * node, best[3], level + 1), (2 * node + 1, best[4], level + 1)]
    return out


@pytest.fixture(scope="module")
def sample(spark, members_small):
    rows = members_small.select("member_key", "Churn_Flag", *FEATURES).orderBy("member_key").limit(140)
    return rows.withColumn("Credit_Limit", F.when(F.col("member_key") % 9 == 0, None).otherwise(F.col("Credit_Limit"))).cache()


@pytest.mark.parametrize("cut,weighted", [("width", True), ("quantile", True), ("width", False)])
def test_tree_equals_a_plain_tree(spark, sample, cut, weighted):
    cuts = (tree.width_cuts if cut == "width" else tree.quantile_cuts)(sample, bins=12)
    frame = sample.toPandas()
    x, y = frame[list(FEATURES)].to_numpy(float), frame.Churn_Flag.to_numpy()
    want = plain_tree(x, y, cuts, 3, weighted)
    nodes = tree.fit_tree(sample.repartition(7), depth=3, cuts=cuts, weighted=weighted)
    got = {r.node: r for r in nodes.collect()}
    assert sorted(got) == sorted(want)
    for k, (feature, threshold, gain, pos, neg) in want.items():
        r = got[k]
        assert (r.feature, r.threshold, r.pos, r.neg) == (feature, threshold, pos, neg)
        assert gain is None or r.gain == pytest.approx(gain, abs=1e-9)
    weights = {k: got[k].gain * got[k].weight for k in got if got[k].feature}
    share = {f: sum(v for k, v in weights.items() if got[k].feature == f) / sum(weights.values()) for f in FEATURES}
    assert {r.feature: r.importance for r in tree.tree_importances(nodes).collect()} == pytest.approx(share)
    # every row's leaf
    scored = {r.member_key: r for r in tree.tree_scores(sample, nodes, 3).collect()}
    for key, row in zip(frame.member_key, x):
        node = 1
        while got[node].feature:
            node = 2 * node + (0 if row[FEATURES.index(got[node].feature)] <= got[node].threshold else 1)
        assert scored[key].node == node and scored[key].Churn_Risk_Score == got[node].p_churn


def test_trees_of_one_class_or_no_rows(spark, sample):
    one = tree.fit_tree(sample.withColumn("Churn_Flag", F.lit(1)), depth=3).collect()
    assert [(r.node, r.feature, r.pos, r.neg, r.p_churn) for r in one] == [(1, None, 140, 0, 1.0)]
    assert tree.fit_tree(sample.limit(0), depth=3).count() == 0
    same = sample.select("member_key", "Churn_Flag", *[F.lit(1.0).alias(c) for c in FEATURES])
    assert tree.fit_tree(same, depth=3).count() == 1
