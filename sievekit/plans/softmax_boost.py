"""M4, M5: multiclass boosting on the softmax objective, distributed.

Every round fits one regression tree per class to the shared gradient p - y of
one stored margin table; all classes' trees grow together, level by level. A
level is one pass: each task sums gradients and Hessians per (class, node,
feature, bin) into arrays, one row per (class, node) and task goes through the
shuffle, and the task that sums them up also picks the split. The driver sees
one row per open node. Leaf values are -T(G) / (H + lambda) with the L1
threshold T; a split must gain ``min_gain`` and leave ``min_child`` Hessian on
both sides.

Gradients are whole multiples of 2^-20 and summed as integers, so the model
doesn't depend on how the rows lie or on the number of tasks. Row and column
sampling are seeded by the row's key, the round and the class.

Margins are written to the shared folder every ``STORE_EVERY`` rounds; between
that, tasks add the trees grown since. Early stopping (M5) is by patience on the
multiclass log-loss of the validation rows, which the next round's first pass
yields for free; the ensemble is cut at its best round.

A missing feature is in a bin of its own below all others. Rows without a label
are left out; validation rows never enter a gradient.
"""

from __future__ import annotations

import json
import math
import random
import sys
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.param import TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievekit.functions.names import col
from sievekit.plans.stages import _param, _Stage, as_array
from sievekit.session import work_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])     # tasks need no installed package

UNIT = float(1 << 20)
STORE_EVERY = 8
LEAF = -1


@dataclass
class Tree:
    """A binary tree in heap order: the split feature and bin of each node, its value where it is a leaf."""

    feature: list = field(default_factory=list)
    bin: list = field(default_factory=list)
    value: list = field(default_factory=list)

    def grown(self, depth: int) -> "Tree":
        n = (2 << depth) - 1
        return Tree([LEAF] * n, [0] * n, [0.0] * n)

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The leaf (or open node) of every row."""
        feature, cut = np.asarray(self.feature), np.asarray(self.bin)
        node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while len(rows):
            rows = rows[feature[node[rows]] != LEAF]
            at = node[rows]
            node[rows] = 2 * at + 1 + (bins[rows, feature[at]] > cut[at])
        return node

    def scores(self, bins: np.ndarray) -> np.ndarray:
        return np.asarray(self.value)[self.nodes(bins)]


def binned(values: np.ndarray, cuts: list[list[float]]) -> np.ndarray:
    """Bin numbers: 0 is missing, b holds values above cut b - 2 and up to cut b - 1."""
    out = np.empty(values.shape, np.uint8)
    for j, c in enumerate(cuts):
        out[:, j] = np.where(np.isnan(values[:, j]), 0, np.searchsorted(c, values[:, j], "left") + 1)
    return out


def softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit_cuts(train: DataFrame, features_col: str, max_bins: int = 32) -> list[list[float]]:
    """Per feature at most ``max_bins - 2`` distinct cut values at even quantiles, one pass."""
    x = as_array(train, features_col)
    n = train.select(F.size(x)).first()[0]
    shares = [i / (max_bins - 1) for i in range(1, max_bins - 1)]
    at = [F.percentile_approx(F.nanvl(F.get(x, F.lit(i)), F.lit(None).cast("double")), shares, 10_000) for i in range(n)]
    return [sorted(set(c or [])) for c in train.agg(F.array(*at)).first()[0]]


@dataclass(frozen=True)
class Settings:
    rounds: int = 500
    rate: float = 0.1
    depth: int = 6
    l1: float = 0.0
    l2: float = 1.0
    min_gain: float = 0.0
    min_child: float = 1.0
    subsample: float = 1.0
    columns: float = 1.0
    max_bins: int = 32
    seed: int = 42
    patience: int = 100


def _threshold(g, l1: float):
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def leaf_value(g: float, h: float, s: Settings) -> float:
    return float(-s.rate * _threshold(g, s.l1) / (h + s.l2)) if h + s.l2 > 0 else 0.0


def best_split(hist: np.ndarray, s: Settings, allowed: np.ndarray):
    """(feature, bin, gain, left G, left H) of sums ``hist`` (feature, bin, G and H); feature -1 if no split is worth it."""
    total = hist[0].sum(0)
    left = np.cumsum(hist, 1)[:, :-1]
    right = total - left

    def score(x):
        return _threshold(x[..., 0], s.l1) ** 2 / np.maximum(x[..., 1] + s.l2, 1e-12)

    gain = 0.5 * (score(left) + score(right) - score(total)) - s.min_gain
    ok = (left[..., 1] >= s.min_child) & (right[..., 1] >= s.min_child) & allowed[:, None]
    gain = np.where(ok, gain, -np.inf)
    f, b = divmod(int(gain.argmax()), gain.shape[1])
    if gain[f, b] <= 1e-9:
        return LEAF, 0, 0.0, 0.0, 0.0
    return f, b, float(gain[f, b]), float(left[f, b, 0]), float(left[f, b, 1])


def _sampled(keys: np.ndarray, round_: int, s: Settings) -> np.ndarray:
    if s.subsample >= 1:
        return np.ones(len(keys), bool)
    h = (keys.view(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (round_ + 1 + (s.seed << 20))) % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return (h >> np.uint64(11)).astype(np.float64) / float(1 << 53) < s.subsample


def _columns(n: int, round_: int, k: int, s: Settings) -> np.ndarray:
    chosen = random.Random(f"{s.seed}/{round_}/{k}").sample(range(n), max(1, math.ceil(n * s.columns)))
    return np.isin(np.arange(n), chosen)


def _rows(batch, n_features: int, n_classes: int):
    n = batch.num_rows
    bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(n, n_features)
    margins = np.frombuffer(b"".join(batch.column("margins").to_pylist()), np.float64).reshape(n, n_classes).copy()
    return bins, margins, batch.column("y").to_numpy(), batch.column("val").to_numpy(zero_copy_only=False)


def _add(margins: np.ndarray, bins: np.ndarray, rounds: list[list[Tree]]):
    for trees in rounds:
        for k, tree in enumerate(trees):
            margins[:, k] += tree.scores(bins)


class _Fit:
    def __init__(self, train: DataFrame, n_classes: int, label_col: str, features_col: str, id_col: str,
                 validation_col: str | None, s: Settings):
        self.spark, self.k, self.s = train.sparkSession, n_classes, s
        known = train.where(col(label_col).isNotNull())
        val = F.coalesce(col(validation_col).cast("boolean"), F.lit(False)) if validation_col else F.lit(False)
        self.cuts = cuts = fit_cuts(known.where(~val), features_col, s.max_bins)
        self.f = len(cuts)

        def prepare(batches):
            for b in batches:
                x = b.column("x")
                values = x.values.slice(x.offsets[0].as_py()).to_numpy(zero_copy_only=False).astype(np.float64)[
                    :x.offsets[-1].as_py() - x.offsets[0].as_py()].reshape(b.num_rows, -1)
                bins, zero = binned(values, cuts), bytes(8 * n_classes)
                yield pa.RecordBatch.from_arrays([b.column("key"), b.column("y"), b.column("val"),
                                                  pa.array([r.tobytes() for r in bins], pa.binary()),
                                                  pa.array([zero] * b.num_rows, pa.binary())], ["key", "y", "val", "bins", "margins"])

        self.schema = "key long, y int, val boolean, bins binary, margins binary"
        rows = known.select(F.xxhash64(col(id_col)).alias("key"), col(label_col).cast("int").alias("y"), val.alias("val"),
                            F.transform(as_array(known, features_col), lambda v: F.coalesce(v, F.lit(float("nan")))).alias("x"))
        self.table = self._stored(rows.mapInArrow(prepare, self.schema))
        self.done: list[list[Tree]] = []        # rounds in the stored margins
        self.since: list[list[Tree]] = []       # and those grown since

    def _stored(self, df: DataFrame) -> DataFrame:
        path = work_dir(self.spark, "margins")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _store(self):
        since, f, k, names = self.since, self.f, self.k, [c.split()[0] for c in self.schema.split(", ")]

        def run(batches):
            for b in batches:
                bins, margins, _, _ = _rows(b, f, k)
                _add(margins, bins, since)
                yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array([r.tobytes() for r in margins], pa.binary())], names)

        self.table = self._stored(self.table.mapInArrow(run, self.schema))
        self.done, self.since = self.done + since, []

    def level(self, trees: list[Tree], depth: int, round_: int):
        """One pass: splits of the open nodes of ``depth`` of all classes, and the validation rows' log-loss before this round."""
        s, f, k, since = self.s, self.f, self.k, self.since
        b = s.max_bins + 1
        first = (1 << depth) - 1
        allowed = [_columns(f, round_, c, s) for c in range(k)]

        def sums(batches):
            hist, loss = {}, np.zeros(2, np.int64)
            for batch in batches:
                bins, margins, y, val = _rows(batch, f, k)
                _add(margins, bins, since)
                p = softmax(margins)
                if val.any():
                    true = np.maximum(p[val, y[val]], 1e-15)
                    loss += [np.rint(-np.log(true) * UNIT).astype(np.int64).sum(), val.sum()]
                use = ~val & _sampled(batch.column("key").to_numpy(), round_, s)
                bins, p, y = bins[use], p[use], y[use]
                place = bins.astype(np.int64) + np.arange(f) * b
                for c in range(k):
                    node = trees[c].nodes(bins) - first
                    rows = np.flatnonzero(node >= 0)
                    if not len(rows):
                        continue
                    open_, at = np.unique(node[rows], return_inverse=True)
                    where = (place[rows] + at[:, None] * (f * b)).ravel()
                    g = np.rint((p[rows, c] - (y[rows] == c)) * UNIT)
                    h = np.rint(np.maximum(2 * p[rows, c] * (1 - p[rows, c]), 1e-6) * UNIT)
                    size = len(open_) * f * b
                    both = np.stack([np.bincount(where, np.repeat(v, f), size) for v in (g, h)], -1).astype(np.int64)
                    for n, part in zip(open_.tolist(), both.reshape(len(open_), f, b, 2)):
                        hist[c, n] = hist[c, n] + part if (c, n) in hist else part
            if loss[1]:
                hist[-1, 0] = loss
            keys = list(hist)
            yield pa.RecordBatch.from_pydict({"c": pa.array([c for c, _ in keys], pa.int32()), "n": pa.array([n for _, n in keys], pa.int32()),
                                              "hist": pa.array([hist[x].tobytes() for x in keys], pa.binary())})

        def choose(table: pa.Table) -> pa.Table:
            c, n = table.column("c")[0].as_py(), table.column("n")[0].as_py()
            total = sum(np.frombuffer(v.as_py(), np.int64) for v in table.column("hist"))
            if c < 0:
                row = (c, n, 0, 0, 0.0, 0.0, total[0] / UNIT, float(total[1]))
            else:
                h = total.reshape(f, b, 2) / UNIT
                split = best_split(h, s, allowed[c])
                row = (c, n, split[0], split[1], split[3], split[4], *h[0].sum(0).tolist())
            return pa.table({x: [v] for x, v in zip(("c", "n", "f", "b", "gl", "hl", "g", "h"), row)},
                            schema=pa.schema([(x, pa.int32()) for x in "cnfb"] + [(x, pa.float64()) for x in ("gl", "hl", "g", "h")]))

        found = (self.table.mapInArrow(sums, "c int, n int, hist binary").groupBy("c", "n")
                     .applyInArrow(choose, "c int, n int, f int, b int, gl double, hl double, g double, h double").collect())
        loss = next((r.g / r.h for r in found if r.c < 0), None)
        return [r for r in found if r.c >= 0], loss

    def round(self, number: int) -> tuple[list[Tree], float | None]:
        s = self.s
        trees, loss = [Tree().grown(s.depth) for _ in range(self.k)], None
        for depth in range(s.depth):
            # closed nodes are leaves: only nodes made by the last level are open
            splits, now = self.level(trees, depth, number)
            loss = now if depth == 0 else loss
            grown = False
            for r in splits:
                tree, at = trees[r.c], (1 << depth) - 1 + r.n
                if depth == 0:
                    tree.value[0] = leaf_value(r.g, r.h, s)
                if r.f == LEAF:
                    continue
                tree.feature[at], tree.bin[at], tree.value[at] = r.f, r.b, 0.0
                tree.value[2 * at + 1] = leaf_value(r.gl, r.hl, s)
                tree.value[2 * at + 2] = leaf_value(r.g - r.gl, r.h - r.hl, s)
                grown = True
            if not grown:
                break
        return trees, loss

    def advance(self, rounds: int):
        """Goes on by ``rounds``, from the margins there are."""
        for number in range(len(self.done) + len(self.since), len(self.done) + len(self.since) + rounds):
            self.since = [*self.since, self.round(number)[0]]
            if len(self.since) >= STORE_EVERY:
                self._store()

    def validation(self) -> dict[str, float]:
        """Log-loss and weighted F1 of the validation rows, one pass; one K x K table of sums per task."""
        f, k, since = self.f, self.k, self.since

        def sums(batches):
            table, loss = np.zeros((k, k), np.int64), 0
            for b in batches:
                bins, margins, y, val = _rows(b, f, k)
                bins, margins, y = bins[val], margins[val], y[val]
                _add(margins, bins, since)
                p = softmax(margins)
                loss += int(np.rint(-np.log(np.maximum(p[np.arange(len(y)), y], 1e-15)) * UNIT).sum())
                np.add.at(table, (y, p.argmax(1)), 1)
            cells = np.argwhere(table)
            yield pa.RecordBatch.from_pydict({"y": pa.array([*cells[:, 0], -1], pa.int32()), "p": pa.array([*cells[:, 1], -1], pa.int32()),
                                              "n": pa.array([*table[tuple(cells.T)], loss], pa.int64())})

        found = self.table.mapInArrow(sums, "y int, p int, n long").groupBy("y", "p").agg(F.sum("n").alias("n")).collect()
        table, loss = np.zeros((k, k)), 0
        for r in found:
            if r.y < 0:
                loss = r.n
            else:
                table[r.y, r.p] = r.n
        support, hit = table.sum(1), np.diag(table)
        f1 = 2 * hit / np.maximum(support + table.sum(0), 1)
        n = max(support.sum(), 1)
        return {"log_loss": float(loss / UNIT / n), "weighted_f1": float((f1 * support).sum() / n)}

    def run(self, watch: bool) -> tuple[list[list[Tree]], list[float]]:
        """All rounds' trees, and the validation log-loss before each and after the last one run."""
        s, losses, best = self.s, [], 0
        for number in range(s.rounds):
            trees, loss = self.round(number)
            if watch:
                losses.append(loss)
                best = min(range(len(losses)), key=lambda i: losses[i])
                if len(losses) - 1 - best >= s.patience:
                    return (self.done + self.since)[:best], losses
            self.since = [*self.since, trees]
            if len(self.since) >= STORE_EVERY:
                self._store()
        rounds = self.done + self.since
        if watch:
            _, loss = self.level([Tree().grown(0) for _ in range(self.k)], 0, s.rounds)
            losses.append(loss)
            rounds = rounds[:min(range(len(losses)), key=lambda i: losses[i])]
        return rounds, losses


class SoftmaxBoost(_Stage, HasInputCol, HasOutputCol):
    """The fitted booster: features -> class probabilities (``array<double>``). Savable."""

    model = _param("model", "cuts, classes and trees as JSON", TypeConverters.toString)

    @classmethod
    def of(cls, cuts: list, rounds: list[list[Tree]], n_classes: int, features_col: str, out: str) -> "SoftmaxBoost":
        text = json.dumps({"classes": n_classes, "cuts": cuts,
                           "rounds": [[[t.feature, t.bin, t.value] for t in trees] for trees in rounds]})
        return cls()._with(inputCol=features_col, outputCol=out, model=text)

    def rounds(self) -> list[list[Tree]]:
        return [[Tree(*t) for t in trees] for trees in json.loads(self.getOrDefault(self.model))["rounds"]]

    def cut_at(self, rounds: int) -> "SoftmaxBoost":
        told = json.loads(self.getOrDefault(self.model))
        return type(self)()._with(inputCol=self.getInputCol(), outputCol=self.getOutputCol(),
                                  model=json.dumps(told | {"rounds": told["rounds"][:rounds]}))

    def _transform(self, df: DataFrame) -> DataFrame:
        told, rounds = json.loads(self.getOrDefault(self.model)), self.rounds()
        cuts, k = told["cuts"], told["classes"]

        @F.pandas_udf("array<double>")
        def probabilities(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=object)
            bins = binned(np.stack([np.asarray(v, np.float64) for v in x]), cuts)
            margins = np.zeros((len(x), k))
            _add(margins, bins, rounds)
            return pd.Series(list(softmax(margins)))

        x = F.transform(as_array(df, self.getInputCol()), lambda v: F.coalesce(v, F.lit(float("nan"))))
        return df.withColumn(self.getOutputCol(), probabilities(x))

    def prefix_log_loss(self, df: DataFrame, label_col: str) -> list[float]:
        """Multiclass log-loss of every prefix of the ensemble (0 rounds first), one pass and one aggregate."""
        told, rounds = json.loads(self.getOrDefault(self.model)), self.rounds()
        cuts, k = told["cuts"], told["classes"]

        def sums(batches):
            total, n = np.zeros(len(rounds) + 1, np.int64), 0
            for b in batches:
                if not b.num_rows:
                    continue
                bins = binned(np.array(b.column("x").to_pylist(), np.float64), cuts)
                y, margins = b.column("y").to_numpy(), np.zeros((b.num_rows, k))
                for i in range(len(rounds) + 1):
                    p = softmax(margins)[np.arange(len(y)), y]
                    total[i] += np.rint(-np.log(np.maximum(p, 1e-15)) * UNIT).astype(np.int64).sum()
                    if i < len(rounds):
                        _add(margins, bins, [rounds[i]])
                n += b.num_rows
            yield pa.RecordBatch.from_pydict({"i": pa.array(range(len(total)), pa.int32()), "s": pa.array(total),
                                              "n": pa.array([n] * len(total), pa.int64())})

        x = F.transform(as_array(df, self.getInputCol()), lambda v: F.coalesce(v, F.lit(float("nan"))))
        rows = df.where(col(label_col).isNotNull()).select(x.alias("x"), col(label_col).cast("int").alias("y"))
        out = rows.mapInArrow(sums, "i int, s long, n long").groupBy("i").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
        return [r.s / UNIT / r.n for r in out.orderBy("i").collect()]


def fit_softmax(train: DataFrame, n_classes: int, id_col: str, label_col: str = "label_idx", features_col: str = "features",
                validation_col: str | None = None, out: str = "probability_arr", **settings) -> tuple[SoftmaxBoost, list[float]]:
    """M4 (and M5, with ``validation_col``): the fitted stage and the validation
    log-loss by round, 0 rounds first. ``settings``: see ``Settings``."""
    fit = _Fit(train, n_classes, label_col, features_col, id_col, validation_col, Settings(**settings))
    rounds, losses = fit.run(validation_col is not None)
    return SoftmaxBoost.of(fit.cuts, rounds, n_classes, features_col, out), losses
