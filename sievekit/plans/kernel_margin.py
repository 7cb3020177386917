"""M7: margin machines on kernels, with cross-fitted probabilities, distributed.

Kernels become features a linear machine can use: random Fourier features for
the radial kernel exp(-gamma |x - y|^2); for the polynomial kernel
(gamma <x, y> + c)^d a count-sketch of the d-fold product, made by multiplying
the Fourier transforms of d count-sketches of x.

One machine per class and fold, and one per class on all rows, are trained
together (squared hinge loss, L2): a step is one pass over the rows, which adds
up the gradients of all machines; a task sends one matrix of (features x
machines). The steps are accelerated gradients of fixed size, 1 / the greatest
curvature the features allow, with a restart when a machine's direction turns.

Probabilities: a row's margin by the machines that have not seen its fold, a
sigmoid per class fitted to these margins (all classes by the same aggregates,
Newton steps), normalised over the classes.

Rows without a label are left out. A missing feature counts as ``centre`` (the
column's mean over the training rows).
"""

from __future__ import annotations

import base64
import json
import math
import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.param import TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievekit.functions.names import col
from sievekit.plans.stages import _param, _Stage, as_array
from sievekit.session import work_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])     # tasks need no installed package


def fourier_features(x: np.ndarray, gamma: float, size: int, seed: int) -> np.ndarray:
    """``size`` features whose products approximate exp(-gamma |x - y|^2)."""
    rng = np.random.default_rng([seed, x.shape[1], size])
    w, b = rng.normal(0, math.sqrt(2 * gamma), (x.shape[1], size)), rng.uniform(0, 2 * math.pi, size)
    return math.sqrt(2 / size) * np.cos(x @ w + b)


def polynomial_features(x: np.ndarray, gamma: float, constant: float, degree: int, size: int, seed: int) -> np.ndarray:
    """``size`` features whose products approximate (gamma <x, y> + constant)^degree."""
    x = np.concatenate([math.sqrt(gamma) * x, np.full((len(x), 1), math.sqrt(constant))], 1)
    rng = np.random.default_rng([seed, x.shape[1], size, degree])
    product = 1.0
    for _ in range(degree):
        place, sign = rng.integers(0, size, x.shape[1]), rng.choice([-1.0, 1.0], x.shape[1])
        sketch = np.zeros((len(x), size))
        for j in range(x.shape[1]):                 # columns that share a place add up
            sketch[:, place[j]] += sign[j] * x[:, j]
        product = product * np.fft.rfft(sketch, axis=1)
    return np.fft.irfft(product, size, axis=1)


def features(x: np.ndarray, kernel: dict, centre: np.ndarray) -> np.ndarray:
    """The machine's features: those of the kernel and a constant 1."""
    x = np.where(np.isnan(x), centre, x) - centre
    if kernel["kind"] == "rbf":
        z = fourier_features(x, kernel["gamma"], kernel["size"], kernel["seed"])
    elif kernel["kind"] == "poly":
        z = polynomial_features(x, kernel["gamma"], kernel["constant"], kernel["degree"], kernel["size"], kernel["seed"])
    elif kernel["kind"] == "linear":
        z = x
    else:
        raise ValueError(f"unknown kernel {kernel['kind']}")
    return np.concatenate([z / kernel["norm"], np.ones((len(z), 1))], 1)


def _matrix(column) -> np.ndarray:
    n = len(column)
    start, end = column.offsets[0].as_py(), column.offsets[-1].as_py()
    return column.values.slice(start, end - start).to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)


def _inputs(df: DataFrame, features_col: str):
    return F.transform(as_array(df, features_col), lambda v: F.coalesce(v, F.lit(float("nan"))))


class _Machines:
    def __init__(self, train: DataFrame, n_classes: int, label_col: str, features_col: str, id_col: str, folds: int, kernel: dict):
        self.spark, self.k, self.folds = train.sparkSession, n_classes, folds
        rows = train.where(col(label_col).isNotNull()).select(
            col(label_col).cast("int").alias("y"), F.pmod(F.xxhash64(col(id_col)), F.lit(folds)).cast("int").alias("fold"),
            _inputs(train, features_col).alias("x"))
        path = work_dir(self.spark, "machines")
        rows.write.parquet(path)
        self.rows = self.spark.read.schema(rows.schema).parquet(path)
        # mean and variance per column, rows per fold: what scales the kernel and the penalty
        stats = (self.rows.select(F.posexplode("x").alias("j", "v")).where(~F.isnan("v"))
                     .groupBy("j").agg(F.avg("v").alias("m"), F.avg(F.col("v") * F.col("v")).alias("q")).collect())
        width = self.rows.agg(F.max(F.size("x"))).first()[0]
        if width is None:
            raise ValueError("no labelled rows")
        self.centre, square = np.zeros(width), np.zeros(width)
        for r in stats:
            self.centre[r.j], square[r.j] = r.m, max(r.q - r.m * r.m, 0.0)
        sizes = dict(self.rows.groupBy("fold").count().collect())
        n = sum(sizes.values())
        self.sizes = np.array([max(1, n - sizes.get(f, 0)) for f in range(folds)] + [n])    # rows of a machine; the last sees all
        variance = square.mean()
        gamma = kernel["gamma"] if kernel["gamma"] is not None else 1 / (width * variance) if variance > 0 else 1.0
        self.kernel = kernel | {"gamma": gamma, "norm": 1.0}
        norm = self._sums(lambda z, y, fold: np.array([(z[:, :-1] ** 2).sum(), len(z)]))
        self.kernel["norm"] = max(math.sqrt(norm[0] / norm[1]), 1e-12)      # features of mean square length 1

    def _sums(self, of) -> np.ndarray:
        """Sum over all rows of ``of(features, y, fold)``; one array per task goes to the driver."""
        kernel, centre = self.kernel, self.centre

        def run(batches):
            total = None
            for b in batches:
                if b.num_rows:
                    own = of(features(_matrix(b.column("x")), kernel, centre), b.column("y").to_numpy(), b.column("fold").to_numpy())
                    total = own if total is None else total + own
            if total is not None:
                yield pa.RecordBatch.from_pydict({"v": pa.array([total.tobytes()], pa.binary()), "shape": pa.array([list(total.shape)])})

        def merge(batches):
            total, shape = None, None
            for b in batches:
                for v, shape in zip(b.column("v").to_pylist(), b.column("shape").to_pylist()):
                    own = np.frombuffer(v, np.float64)
                    total = own.copy() if total is None else total + own
            if total is not None:
                yield pa.RecordBatch.from_pydict({"v": pa.array([total.tobytes()], pa.binary()), "shape": pa.array([shape])})

        kind = "v binary, shape array<long>"
        parts, width = self.rows.mapInArrow(run, kind), self.rows.rdd.getNumPartitions()
        while width > 32:                       # a tree: no task and not the driver adds up more than 32 of them
            width = -(-width // 32)
            parts = parts.repartition(width).mapInArrow(merge, kind)
        found = [np.frombuffer(r.v, np.float64).reshape(r.shape) for r in parts.collect()]
        return sum(found)

    def fit(self, c: float, steps: int, tolerance: float) -> np.ndarray:
        """Weights (features x machines); machine f * k + class leaves out fold f, the last k see all rows.
        A machine minimises |w|^2 / 2 + c * the sum of its rows' squared hinge losses, over its rows' number."""
        k, folds = self.k, self.folds
        size = {"linear": len(self.centre)}.get(self.kernel["kind"], self.kernel["size"]) + 1
        rows = np.repeat(self.sizes, k).astype(np.float64)
        penalty = 1 / (c * rows)
        penalty = np.stack([penalty] * (size - 1) + [np.zeros_like(penalty)])       # none on the constant
        # the curvature is at most twice the largest eigenvalue of the features' mean square
        gram = self._sums(lambda z, y, fold: z.T @ z) / self.sizes[-1]
        step = 1 / (2 * np.linalg.eigvalsh(gram)[-1] * self.sizes[-1] / self.sizes.min() + penalty.max())
        w = at = np.zeros((size, k * (folds + 1)))
        t = np.ones(w.shape[1])
        for _ in range(steps):
            def gradient(z, y, fold, at=at):
                sign = np.where(y[:, None] == np.arange(k), 1.0, -1.0)
                sign = np.tile(sign, folds + 1)
                slack = np.maximum(1 - sign * (z @ at), 0)
                own = np.concatenate([np.repeat(fold[:, None] != np.arange(folds), k, 1), np.ones((len(y), k), bool)], 1)
                return z.T @ (-2 * sign * slack * own)

            g = self._sums(gradient) / rows + penalty * at
            after = at - step * g
            turned = (g * (after - w)).sum(0) > 0
            t = np.where(turned, 1.0, t)
            then = (1 + np.sqrt(1 + 4 * t * t)) / 2
            at, w, t = after + ((t - 1) / then) * (after - w), after, then
            if np.abs(g).max() < tolerance:
                break
        return w

    def unseen_margins(self, w: np.ndarray) -> DataFrame:
        """(k, hit, m): every row's margin for each class by the machines that left its fold out."""
        kernel, centre, k, folds = self.kernel, self.centre, self.k, self.folds

        def run(batches):
            for b in batches:
                z, fold = features(_matrix(b.column("x")), kernel, centre), b.column("fold").to_numpy()
                m = (z @ w).reshape(len(z), folds + 1, k)[np.arange(len(z)), fold]
                yield pa.RecordBatch.from_arrays([b.column("y"), pa.array(list(m), pa.list_(pa.float64()))], ["y", "m"])

        rows = self.rows.mapInArrow(run, "y int, m array<double>")
        path = work_dir(self.spark, "unseen")
        rows.select("y", F.posexplode("m").alias("k", "m")).select("k", (F.col("y") == F.col("k")).alias("hit"), "m").write.parquet(path)
        return self.spark.read.schema("k int, hit boolean, m double").parquet(path)


def fit_sigmoids(margins: DataFrame, n_classes: int, steps: int = 30) -> list[tuple[float, float]]:
    """(a, b) per class of 1 / (1 + exp(-(a m + b))) on (k, hit, m). Targets are
    drawn in by one row on each side, so no class runs off to infinity; a Newton
    step is one aggregate for all classes, halved until the loss falls."""
    n = {r.k: (r.hits, r.n) for r in margins.groupBy("k").agg(F.count_if("hit").alias("hits"), F.count(F.lit(1)).alias("n")).collect()}
    hits, misses = (np.array([n.get(k, (0, 0))[0] for k in range(n_classes)], float),
                    np.array([n.get(k, (0, 0))[1] - n.get(k, (0, 0))[0] for k in range(n_classes)], float))
    high, low = (hits + 1) / (hits + 2), 1 / (misses + 2)
    at = np.stack([np.zeros(n_classes), np.log((hits + 1) / (misses + 1))], 1)
    spark, moved, best = margins.sparkSession, np.zeros((n_classes, 2)), np.full(n_classes, np.inf)
    m, p = F.col("m"), F.col("p")
    for _ in range(steps):
        told = spark.createDataFrame([(k, *map(float, at[k]), float(high[k]), float(low[k])) for k in range(n_classes)],
                                     "k int, a double, b double, high double, low double")
        rows = (margins.join(F.broadcast(told), "k")         # a row per class
                       .withColumn("s", F.col("a") * m + F.col("b")).withColumn("t", F.when(F.col("hit"), F.col("high")).otherwise(F.col("low")))
                       .withColumn("p", 1 / (1 + F.exp(-F.col("s")))))
        loss = F.greatest(F.col("s"), F.lit(0.0)) + F.log1p(F.exp(-F.abs("s"))) - F.col("t") * F.col("s")
        d, h = p - F.col("t"), p * (1 - p)
        sums = rows.groupBy("k").agg(F.sum(loss).alias("loss"), F.sum(d * m).alias("ga"), F.sum(d).alias("gb"),
                                     F.sum(h * m * m).alias("aa"), F.sum(h * m).alias("ab"), F.sum(h).alias("bb")).collect()
        going = False
        for r in sums:
            k = r.k
            if r.loss > best[k] + 1e-12 * abs(best[k]):      # too far: half the way back
                moved[k] /= 2
                at[k] -= moved[k]
                going |= np.abs(moved[k]).max() > 1e-9
                continue
            best[k] = r.loss
            hessian = np.array([[r.aa + 1e-9, r.ab], [r.ab, r.bb + 1e-9]])
            moved[k] = -np.linalg.solve(hessian, np.array([r.ga, r.gb]))
            at[k] += moved[k]
            going |= np.abs(moved[k]).max() > 1e-7
        if not going:
            break
    return [tuple(map(float, v)) for v in at]


class KernelMargin(_Stage, HasInputCol, HasOutputCol):
    """The fitted machines: features -> class probabilities (``array<double>``). Savable."""

    model = _param("model", "kernel, centre, weights and sigmoids as JSON", TypeConverters.toString)

    @classmethod
    def of(cls, kernel: dict, centre: np.ndarray, weights: np.ndarray, sigmoids: list, features_col: str, out: str) -> "KernelMargin":
        told = {"kernel": kernel, "centre": centre.tolist(), "sigmoids": sigmoids, "classes": weights.shape[1],
                "weights": base64.b64encode(np.ascontiguousarray(weights).tobytes()).decode()}
        return cls()._with(inputCol=features_col, outputCol=out, model=json.dumps(told))

    def _scored(self, df: DataFrame, out: str, of) -> DataFrame:
        told = json.loads(self.getOrDefault(self.model))
        kernel, centre, k = told["kernel"], np.array(told["centre"]), told["classes"]
        w = np.frombuffer(base64.b64decode(told["weights"]), np.float64).reshape(-1, k)
        a, b = np.array(told["sigmoids"]).T

        @F.pandas_udf("array<double>")
        def scores(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=object)
            return pd.Series(list(of(features(np.stack([np.asarray(v, np.float64) for v in x]), kernel, centre) @ w, a, b)))

        return df.withColumn(out, scores(_inputs(df, self.getInputCol())))

    def margins(self, df: DataFrame, out: str = "margins") -> DataFrame:
        """The classes' bare margins as ``out``: where unseen rows told the
        sigmoids nothing, all probabilities are the classes' shares."""
        return self._scored(df, out, lambda margin, a, b: margin)

    def _transform(self, df: DataFrame) -> DataFrame:
        def probabilities(margin, a, b):
            # shares of the sigmoids by their logarithms, which don't vanish far out
            log = -np.logaddexp(0, -(a * margin + b))
            p = np.exp(log - log.max(1, keepdims=True))
            return p / p.sum(1, keepdims=True)

        return self._scored(df, self.getOutputCol(), probabilities)


def fit_kernel_margin(train: DataFrame, n_classes: int, id_col: str, kernel: str = "rbf", c: float = 1.0, gamma: float | None = None,
                      constant: float = 0.0, degree: int = 3, size: int = 512, folds: int = 5, steps: int = 150,
                      tolerance: float = 1e-4, seed: int = 42, label_col: str = "label_idx", features_col: str = "features",
                      out: str = "probability_arr") -> KernelMargin:
    """M7: the fitted stage. ``gamma``: by default 1 / (columns x variance).
    ``size`` features stand for the kernel (the error of a kernel value falls with
    its root). At most ``steps`` passes, fewer once no gradient is above ``tolerance``."""
    machines = _Machines(train, n_classes, label_col, features_col, id_col, folds,
                         {"kind": kernel, "gamma": gamma, "constant": constant, "degree": degree, "size": size, "seed": seed})
    w = machines.fit(c, steps, tolerance)
    sigmoids = fit_sigmoids(machines.unseen_margins(w), n_classes)
    return KernelMargin.of(machines.kernel, machines.centre, w[:, -n_classes:], sigmoids, features_col, out)
