"""Kernel features against the kernels; machines and sigmoids against direct minimisation."""

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector

from sievekit.plans import kernel_margin as M
from sievekit.plans import training
from tests.test_softmax_boost import frame, rings


def test_features_approximate_the_kernels():
    x = np.random.default_rng(1).normal(0, 0.6, (60, 5))
    rbf = np.exp(-0.7 * ((x[:, None] - x[None]) ** 2).sum(2))
    poly = (0.5 * x @ x.T + 1) ** 3
    errors = []
    for size in (256, 4096):
        z = M.fourier_features(x, 0.7, size, 3)
        p = M.polynomial_features(x, 0.5, 1.0, 3, size, 3)
        errors.append((np.sqrt(np.mean((z @ z.T - rbf) ** 2)), np.sqrt(np.mean((p @ p.T - poly) ** 2) / np.mean(poly ** 2))))
    assert errors[1][0] < 0.02 and errors[1][1] < 0.1
    assert errors[1][0] < errors[0][0] / 2 and errors[1][1] < errors[0][1] / 2


def two_rings(n, seed):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n)
    angle, r = rng.uniform(0, 2 * math.pi, n), np.where(y == 1, 1.0, 0.4) + rng.normal(0, 0.08, n)
    return np.stack([r * np.cos(angle), r * np.sin(angle)], 1), y


def predicted(model, df):
    return np.array([r[0] for r in model.transform(df).orderBy("id").select("probability_arr").collect()])


@pytest.mark.parametrize("kernel", ["rbf", "poly"])
def test_two_rings(spark, tmp_path, kernel):
    (x, y), (hx, hy) = two_rings(400, 1), two_rings(300, 2)
    kw = dict(size=128, folds=2, steps=30, c=10.0, degree=2, constant=1.0)
    model = M.fit_kernel_margin(frame(spark, x, y), 2, "id", kernel=kernel, gamma=3.0, **kw)
    test = frame(spark, hx, hy)
    p = predicted(model, test)
    assert np.allclose(p.sum(1), 1) and (p.argmax(1) == hy).mean() > 0.97
    bare = np.array([r[0] for r in model.margins(test).orderBy("id").select("margins").collect()])
    assert (bare.argmax(1) == hy).mean() > 0.97
    PipelineModel([model]).write().overwrite().save(str(tmp_path / "m"))
    assert np.array_equal(predicted(PipelineModel.load(str(tmp_path / "m")), test), p)
    if kernel == "rbf":
        flat = predicted(M.fit_kernel_margin(frame(spark, x, y), 2, "id", kernel="linear", **kw), test)
        assert (flat.argmax(1) == hy).mean() < 0.75


def test_machines_reach_the_minimum(spark):
    x, y = rings(150, 3)
    machines = M._Machines(frame(spark, x, y), 3, "label_idx", "features", "id", 2,
                           {"kind": "linear", "gamma": None, "constant": 0.0, "degree": 0, "size": 0, "seed": 1})
    w = machines.fit(1.0, 150, 1e-6)
    rows = machines.rows.collect()
    z = M.features(np.array([r.x for r in rows]), machines.kernel, machines.centre)
    fold, label = np.array([r.fold for r in rows]), np.array([r.y for r in rows])
    for machine in range(9):
        own = fold != machine // 3 if machine < 6 else np.ones(len(rows), bool)
        s = np.where(label[own] == machine % 3, 1.0, -1.0)
        v = w[:, machine]
        slack = np.maximum(1 - s * (z[own] @ v), 0)
        gradient = np.append(v[:-1], 0) - 2 * z[own].T @ (s * slack)        # c = 1, not divided by the rows
        assert np.abs(gradient).max() < 1e-3


def test_sigmoids_reach_the_minimum(spark):
    rng = np.random.default_rng(5)
    m = rng.normal(0, 2, (300, 2))
    hit = rng.random((300, 2)) < 1 / (1 + np.exp(-(1.5 * m - 0.7)))
    rows = [(k, bool(hit[i, k]), float(m[i, k])) for i in range(300) for k in range(2)]
    rows += [(2, False, float(v)) for v in m[:, 0]]                          # a class without a row
    found = M.fit_sigmoids(spark.createDataFrame(rows, "k int, hit boolean, m double"), 3)
    for k in range(2):
        n = hit[:, k].sum()
        t = np.where(hit[:, k], (n + 1) / (n + 2), 1 / (300 - n + 2))
        p = 1 / (1 + np.exp(-(found[k][0] * m[:, k] + found[k][1])))
        assert abs((p - t).sum()) < 1e-4 and abs(((p - t) * m[:, k]).sum()) < 1e-4
    assert all(map(math.isfinite, found[2])) and 1 / (1 + math.exp(-found[2][1])) < 0.05


def test_cross_fitted_probabilities_beat_those_of_seen_rows(spark):
    """Few rows, many features: margins of seen rows are too sure of themselves."""
    rng = np.random.default_rng(8)

    def made(n):
        y = rng.integers(0, 3, n)
        return rng.normal(0, 1, (n, 40)) + 0.7 * np.eye(40)[y] * 2, y

    (x, y), (hx, hy) = made(150), made(600)
    train, test = frame(spark, x, y), frame(spark, hx, hy)

    def loss(p):
        return -np.log(np.maximum(p[np.arange(len(hy)), hy], 1e-15)).mean()

    crossed = loss(predicted(M.fit_kernel_margin(train, 3, "id", kernel="linear", c=10.0, steps=40), test))
    vectors = lambda df: df.withColumn("features", array_to_vector("features"))
    seen = loss(predicted(training.fit_margin_prob(vectors(train), 3, max_iter=30), vectors(test)))
    assert crossed < seen and crossed < math.log(3)


def test_odd_rows(spark):
    x, y = rings(80, 6)
    x[:, 2] = 1.0                                                            # no variance
    model = M.fit_kernel_margin(frame(spark, x, [None if i % 10 == 0 else c for i, c in enumerate(y)]), 4, "id", size=32, steps=5, folds=2)
    gone = spark.createDataFrame([(1, [None] * 4), (2, [1e9, -1e9, 0.0, None])], "id long, features array<double>")
    assert np.allclose(predicted(model, gone).sum(1), 1)
    assert model.transform(gone.where("false")).count() == 0
    flat = M.fit_kernel_margin(frame(spark, np.zeros((40, 3)), y[:40]), 3, "id", size=16, steps=5, folds=2)
    assert np.isfinite(predicted(flat, frame(spark, np.zeros((4, 3)), y[:4]))).all()
    with pytest.raises(ValueError):
        M.fit_kernel_margin(frame(spark, x, y).where("false"), 3, "id")
    with pytest.raises(Exception, match="unknown kernel"):
        M.fit_kernel_margin(frame(spark, x, y), 3, "id", kernel="other")
