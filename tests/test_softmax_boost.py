"""Softmax boosting against plain Python, and its patience against all prefixes."""

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from sievekit.plans import softmax_boost as B


def rings(n, seed, classes=3):
    """Points whose class is the ring they lie in, some labels wrong; one useless and one partly missing column."""
    rng = np.random.default_rng(seed)
    x = rng.uniform(-1, 1, (n, 4)).round(3)
    y = np.minimum((np.hypot(x[:, 0], x[:, 1]) * 2.4).astype(int), classes - 1)
    y = np.where(rng.random(n) < 0.08, rng.integers(0, classes, n), y)
    x[rng.random(n) < 0.2, 3] = np.nan
    return x, y


def frame(spark, x, y, partitions=3, **extra):
    rows = [(i, float(c) if c is not None else None, [None if math.isnan(v) else float(v) for v in r], *(e[i] for e in extra.values()))
            for i, (r, c) in enumerate(zip(x, y))]
    names = ", ".join(f"{n} boolean" for n in extra)
    return spark.createDataFrame(rows, "id long, label_idx double, features array<double>" + (", " + names if names else "")
                                 ).repartition(partitions)


def brute(x, y, k, cuts, s):
    """Margins after each round by direct sums over rows for every node, feature and cut."""
    bins = np.zeros(x.shape, int)
    for i in range(x.shape[0]):
        for j in range(x.shape[1]):
            bins[i, j] = 0 if math.isnan(x[i, j]) else 1 + sum(c < x[i, j] for c in cuts[j])
    margins, out = np.zeros((len(y), k)), []

    def value(rows, g, h):
        gs = g[rows].sum()
        return -s.rate * np.sign(gs) * max(abs(gs) - s.l1, 0) / (h[rows].sum() + s.l2)

    def grow(rows, g, h, depth, scores):
        def part(r):
            return max(abs(g[r].sum()) - s.l1, 0) ** 2 / (h[r].sum() + s.l2)
        best = (1e-9, None)
        if depth < s.depth:
            for j in range(x.shape[1]):
                for b in range(s.max_bins):
                    low, high = rows[bins[rows, j] <= b], rows[bins[rows, j] > b]
                    if h[low].sum() >= s.min_child and h[high].sum() >= s.min_child:
                        gain = 0.5 * (part(low) + part(high) - part(rows)) - s.min_gain
                        if gain > best[0] + 1e-12:
                            best = (gain, (low, high))
        if best[1] is None:
            scores[rows] = value(rows, g, h)
        else:
            for side in best[1]:
                grow(side, g, h, depth + 1, scores)

    for _ in range(s.rounds):
        e = np.exp(margins)
        p = e / e.sum(1, keepdims=True)
        step = np.zeros_like(margins)
        for c in range(k):
            g = np.rint((p[:, c] - (y == c)) * B.UNIT) / B.UNIT
            h = np.rint(2 * p[:, c] * (1 - p[:, c]) * B.UNIT) / B.UNIT
            grow(np.arange(len(y)), g, h, 0, step[:, c])
        margins = margins + step
        out.append(margins)
    return out


@pytest.mark.parametrize("extra", [{}, {"l1": 0.5, "l2": 3.0, "min_gain": 0.2, "min_child": 4.0}])
def test_equals_brute_force(spark, extra):
    x, y = rings(200, 1)
    kw = dict(rounds=3, depth=3, max_bins=8, **extra)
    df = frame(spark, x, y)
    model, _ = B.fit_softmax(df, 3, "id", **kw)
    cuts = B.fit_cuts(df, "features", 8)
    want = B.softmax(brute(x, y, 3, cuts, B.Settings(**kw))[-1])
    got = np.array([r[0] for r in model.transform(df).orderBy("id").select("probability_arr").collect()])
    assert np.abs(got - want).max() < 1e-9
    if extra:
        assert min(len([f for f in t.feature if f != B.LEAF]) for trees in model.rounds() for t in trees) < 7


def test_one_model_however_the_rows_lie(spark):
    x, y = rings(300, 2)
    kw = dict(rounds=10, depth=2, max_bins=16, subsample=0.7, columns=0.5)      # beyond one stored margin table
    texts = {B.fit_softmax(frame(spark, x, y, n), 3, "id", **kw)[0].getOrDefault("model") for n in (1, 8, 40)}
    assert len(texts) == 1
    assert B.fit_softmax(frame(spark, x, y), 3, "id", **kw | {"seed": 7})[0].getOrDefault("model") not in texts


def test_loss_falls_every_round(spark):
    x, y = rings(1200, 3)
    hx, hy = rings(600, 4)
    train, test = frame(spark, x, y), frame(spark, hx, hy)
    model, _ = B.fit_softmax(train, 3, "id", rounds=12, depth=3, rate=0.3)
    losses = model.prefix_log_loss(train, "label_idx")
    assert losses[0] == pytest.approx(math.log(3), abs=1e-5) and all(b < a for a, b in zip(losses, losses[1:]))
    assert model.prefix_log_loss(test, "label_idx")[-1] < 0.55
    got = model.transform(test).select(F.expr("array_position(probability_arr, array_max(probability_arr)) - 1 = label_idx").alias("hit"))
    assert got.where("hit").count() > 0.85 * 600


def test_patience_picks_the_best_prefix(spark):
    x, y = rings(400, 5)
    val = (np.arange(400) % 3 == 0).tolist()
    y = np.where(np.arange(400) % 5 == 0, (y + 1) % 3, y)           # noise: it overfits soon
    df = frame(spark, x, y, val=val)
    kw = dict(depth=4, rate=0.8, l2=0.1, min_child=0.1)
    full, _ = B.fit_softmax(df.where("NOT val"), 3, "id", rounds=14, **kw)
    every = full.prefix_log_loss(df.where("val"), "label_idx")
    stopped, losses = B.fit_softmax(df, 3, "id", validation_col="val", rounds=14, patience=3, **kw)
    assert losses == pytest.approx(every[:len(losses)], abs=1e-6)
    best = int(np.argmin(losses))
    assert len(stopped.rounds()) == best and len(losses) - 1 - best == 3 and len(losses) < len(every)
    assert stopped.rounds() == full.cut_at(best).rounds()
    most, all_losses = B.fit_softmax(df, 3, "id", validation_col="val", rounds=14, patience=100, **kw)
    assert len(all_losses) == 15 and len(most.rounds()) == int(np.argmin(every))


def test_odd_rows(spark, tmp_path):
    x, y = rings(60, 6)
    df = frame(spark, x, [None if i % 10 == 0 else c for i, c in enumerate(y)])
    model, _ = B.fit_softmax(df, 3, "id", rounds=2, depth=2)
    PipelineModel([model]).write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    gone = spark.createDataFrame([(1, [None] * 4), (2, [1e9, -1e9, 0.0, None])], "id long, features array<double>")
    a, b = (sorted(map(tuple, m.transform(gone).select("id", "probability_arr").collect())) for m in (model, loaded))
    assert a == b and all(sum(p) == pytest.approx(1) for _, p in a)
    assert model.transform(gone.where("false")).count() == 0
    one_class, _ = B.fit_softmax(frame(spark, x, np.zeros(60, int)), 2, "id", rounds=2, depth=2)
    assert one_class.prefix_log_loss(frame(spark, x, np.zeros(60, int)), "label_idx")[-1] < math.log(2)
