"""Randomised trees against a plain recursion with the same draws."""

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel

from sievekit.plans import random_trees as R
from tests.test_softmax_boost import frame, rings


def brute(x, y, k, seed, tree, n, min_leaf=1, max_depth=None):
    """[(feature, threshold, class counts)] of one tree in the order its nodes are made."""
    nodes = [(R.LEAF, 0.0, None)]
    level, depth = [(0, list(range(len(y))))], 0
    nodes[0] = (R.LEAF, 0.0, [sum(y[i] == c for i in level[0][1]) for c in range(k)])
    while level:
        below = []
        for node, rows in level:
            counts = nodes[node][2]
            if len(rows) < 2 * min_leaf or sum(c > 0 for c in counts) < 2 or depth == max_depth:
                continue
            tried = []
            for j in range(x.shape[1]):
                known = [x[i, j] for i in rows if not math.isnan(x[i, j])]
                if known and min(known) < max(known):
                    u = float(R.draw(seed, tree, node, j, 1))
                    tried.append((float(R.draw(seed, tree, node, j, 0)), j, min(known) * (1 - u) + max(known) * u))
            best = None
            for _, j, cut in sorted(tried)[:n]:
                right = [i for i in rows if x[i, j] > cut]
                left = [i for i in rows if not x[i, j] > cut]
                if min(len(left), len(right)) < min_leaf:
                    continue
                score = sum(sum(sum(y[i] == c for i in part) ** 2 for c in range(k)) / len(part) for part in (left, right))
                if best is None or score > best[0]:
                    best = (score, j, cut, left, right)
            if best:
                nodes[node] = (best[1], best[2], counts)
                for part in best[3:]:
                    below.append((len(nodes), part))
                    nodes.append((R.LEAF, 0.0, [sum(y[i] == c for i in part) for c in range(k)]))
        level, depth = below, depth + 1
    return nodes


@pytest.mark.parametrize("kw", [{}, {"min_leaf": 5, "max_depth": 4, "features": 4}])
def test_equals_brute_force(spark, monkeypatch, kw):
    x, y = rings(200, 1)
    x[:, 2] = 0.5                                                   # one value: never drawn
    if kw:
        monkeypatch.setattr(R, "PASS_BYTES", 4000)                  # several passes a level
    model = R.fit_random_trees(frame(spark, x, y), 3, num_trees=4, seed=9, **kw)
    for t, (tree, counts) in enumerate(model.trees()):
        want = brute(x, y, 3, 9, t, kw.get("features", 2), kw.get("min_leaf", 1), kw.get("max_depth"))
        assert tree.feature == [f for f, _, _ in want] and 2 not in tree.feature
        assert tree.threshold == pytest.approx([c for _, c, _ in want])
        assert counts.tolist() == [c for _, _, c in want]


def test_seed_and_partitions(spark):
    x, y = rings(300, 2)
    models = {R.fit_random_trees(frame(spark, x, y, n), 3, num_trees=5).getOrDefault("model") for n in (1, 8, 40)}
    assert len(models) == 1
    assert R.fit_random_trees(frame(spark, x, y), 3, num_trees=5, seed=7).getOrDefault("model") not in models


def test_learns_and_survives_saving(spark, tmp_path):
    x, y = rings(900, 3)
    hx, hy = rings(400, 4)
    model = R.fit_random_trees(frame(spark, x, y), 3, num_trees=30, min_leaf=3)
    PipelineModel([model]).write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    test = frame(spark, hx, hy)
    a, b = (np.array([r[0] for r in m.transform(test).orderBy("id").select("probability_arr").collect()]) for m in (model, loaded))
    assert np.array_equal(a, b) and np.allclose(a.sum(1), 1)
    assert (a.argmax(1) == hy).mean() > 0.8


def test_odd_rows(spark):
    x, y = rings(60, 6)
    model = R.fit_random_trees(frame(spark, x, [None if i % 10 == 0 else c for i, c in enumerate(y)]), 3, num_trees=3)
    assert all(counts[0].sum() == 54 for _, counts in model.trees())
    gone = spark.createDataFrame([(1, [None] * 4), (2, [1e9, -1e9, 0.0, None])], "id long, features array<double>")
    assert all(sum(r[0]) == pytest.approx(1) for r in model.transform(gone).select("probability_arr").collect())
    assert model.transform(gone.where("false")).count() == 0
    one = R.fit_random_trees(frame(spark, x, np.zeros(60, int)), 2, num_trees=2)
    assert all(tree.feature == [R.LEAF] for tree, _ in one.trees())
    same = R.fit_random_trees(frame(spark, np.zeros((60, 4)), y), 3, num_trees=2)          # nothing varies
    assert all(tree.feature == [R.LEAF] for tree, _ in same.trees())
    wide = np.where(x > 0, 1.7e308, -1.7e308)                                               # a difference would overflow
    huge = R.fit_random_trees(frame(spark, wide, y), 3, num_trees=2)
    assert all(np.isfinite(tree.threshold).all() for tree, _ in huge.trees())
    with pytest.raises(ValueError):
        R.fit_random_trees(frame(spark, x, y).where("false"), 3)
