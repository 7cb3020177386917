"""M6: extremely randomised trees, distributed.

Every tree sees all rows. At each node one threshold per feature is drawn
between the least and the largest value among the node's rows; of ``features``
such features that vary there, the split with the best Gini score is taken.

The open nodes of a level, of all trees, are numbered; two aggregates do a
level: least and largest value per (node, feature), from which the summing task
draws the thresholds, and class counts left of each drawn threshold, from which
it picks the split. What the driver sees of a node is its split, so it holds the
model and nothing else. A pass takes as many nodes as ``PASS_BYTES`` hold;
further nodes have passes of their own.

Draws are hashes of (seed, tree, node, feature) and counts are whole numbers:
the model depends on the rows and the seed alone, not on how they lie.

A missing value goes left. Rows without a label are left out. A feature with one
value in a node isn't drawn there; a node where none varies is a leaf.
"""

from __future__ import annotations

import base64
import json
import math
import sys
import zlib

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

PASS_BYTES = 64 << 20       # of sums in a task
LEAF = -1


def draw(seed: int, tree, node, feature, use: int) -> np.ndarray:
    """Uniform numbers in [0, 1), one per (tree, node, feature); arrays broadcast."""
    with np.errstate(over="ignore"):
        h = np.uint64((seed * 0x9E3779B97F4A7C15 + use) % (1 << 64))
        for part in (tree, node, feature):
            h = h ^ (np.asarray(part).astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
            h = h ^ (h >> np.uint64(31))
    return (h >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def drawn_splits(seed: int, tree, node, low: np.ndarray, high: np.ndarray, n: int):
    """Per node the ``n`` features drawn among those that vary (LEAF: no more of them) and their thresholds."""
    tree, node, at = np.asarray(tree)[:, None], np.asarray(node)[:, None], np.arange(low.shape[1])[None, :]
    order = np.where(low < high, draw(seed, tree, node, at, 0), 2.0)
    chosen = np.argsort(order, 1, kind="stable")[:, :n]
    rows = np.arange(len(low))[:, None]
    lo, hi = low[rows, chosen], high[rows, chosen]
    varies = order[rows, chosen] < 2
    lo, hi = np.where(varies, lo, 0.0), np.where(varies, hi, 0.0)
    share = draw(seed, tree, node, chosen, 1)
    cut = lo * (1 - share) + hi * share         # no difference: it may overflow
    return np.where(varies, chosen, LEAF), np.where(cut < hi, np.maximum(cut, lo), lo)


def best_split(left: np.ndarray, total: np.ndarray, feature: np.ndarray, min_leaf: int):
    """Per node the place of the best drawn split by Gini, LEAF if none leaves ``min_leaf`` rows on both sides."""
    right = total[:, None, :] - left
    nl, nr = left.sum(2), right.sum(2)
    ok = (feature != LEAF) & (nl >= min_leaf) & (nr >= min_leaf)
    score = (left.astype(np.float64) ** 2).sum(2) / np.maximum(nl, 1) + (right.astype(np.float64) ** 2).sum(2) / np.maximum(nr, 1)
    score = np.where(ok, score, -1.0)
    return np.where(ok.any(1), score.argmax(1), LEAF)


class Tree:
    """Nodes in the order they were made; the children of a split are ``left`` and ``left + 1``."""

    def __init__(self, feature=(LEAF,), threshold=(0.0,), left=(LEAF,)):
        self.feature, self.threshold, self.left = list(feature), list(threshold), list(left)

    def nodes(self, x: np.ndarray) -> np.ndarray:
        feature, cut, left = np.asarray(self.feature), np.asarray(self.threshold), np.asarray(self.left)
        node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        while len(rows):
            rows = rows[feature[node[rows]] != LEAF]
            at = node[rows]
            node[rows] = left[at] + (x[rows, feature[at]] > cut[at])
        return node


def _matrix(column) -> np.ndarray:
    n = len(column)
    start, end = column.offsets[0].as_py(), column.offsets[-1].as_py()
    values = column.values.slice(start, end - start).to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(n, -1) if n else np.zeros((0, 0))


def _slots(trees: dict[int, Tree], where: dict[int, np.ndarray], x: np.ndarray):
    """(rows, slots) per tree: the rows that lie in a node of this pass, and its number there."""
    for t, tree in trees.items():
        slot = where[t][tree.nodes(x)]
        rows = np.flatnonzero(slot >= 0)
        if len(rows):
            yield rows, slot[rows]


class _Forest:
    def __init__(self, train: DataFrame, n_classes: int, label_col: str, features_col: str, num_trees: int,
                 max_depth: int | None, min_leaf: int, features: int | None, seed: int):
        self.spark, self.k, self.seed, self.min_leaf = train.sparkSession, n_classes, seed, min_leaf
        x = F.transform(as_array(train, features_col), lambda v: F.coalesce(v, F.lit(float("nan"))))
        rows = train.where(col(label_col).isNotNull()).select(col(label_col).cast("int").alias("y"), x.alias("x"))
        path = work_dir(self.spark, "trees")
        rows.write.parquet(path)
        self.rows = self.spark.read.schema(rows.schema).parquet(path)
        sizes = {r.y: (r.n, r.f) for r in self.rows.groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("f")).collect()}
        if not sizes:
            raise ValueError("no labelled rows")
        self.f = max(f for _, f in sizes.values())
        self.n = max(1, min(self.f, features or math.isqrt(self.f)))
        root = np.array([sizes.get(c, (0, 0))[0] for c in range(n_classes)], np.int64)
        self.trees = [Tree() for _ in range(num_trees)]
        self.counts = [[root] for _ in range(num_trees)]
        self.max_depth = max_depth

    def open(self, counts: np.ndarray) -> bool:
        return counts.sum() >= 2 * self.min_leaf and np.count_nonzero(counts) > 1

    def grow(self):
        depth = 0
        level = [(t, 0) for t in range(len(self.trees)) if self.open(self.counts[t][0])]
        size = max(1, PASS_BYTES // (16 * max(self.f, self.n * self.k)))
        while level and (self.max_depth is None or depth < self.max_depth):
            # the trees of this level stay as they are until all its passes are done
            splits = [s for i in range(0, len(level), size) for s in self.level(level[i:i + size])]
            level, depth = [], depth + 1
            for t, node, feature, cut, left in splits:
                tree, counts = self.trees[t], self.counts[t]
                tree.feature[node], tree.threshold[node], tree.left[node] = feature, cut, len(tree.feature)
                for own in (left, counts[node] - left):
                    if self.open(own):
                        level.append((t, len(tree.feature)))
                    tree.feature.append(LEAF), tree.threshold.append(0.0), tree.left.append(LEAF)
                    counts.append(own)

    def level(self, nodes: list[tuple[int, int]]):
        """The splits of ``nodes``: (tree, node, feature, threshold, class counts left of it)."""
        f, k, n, seed, min_leaf, m = self.f, self.k, self.n, self.seed, self.min_leaf, len(nodes)
        tree_of, node_of = np.array([t for t, _ in nodes]), np.array([a for _, a in nodes])
        trees = {t: self.trees[t] for t in sorted(set(tree_of.tolist()))}
        where = {t: np.full(len(tree.feature), -1) for t, tree in trees.items()}
        for s, (t, a) in enumerate(nodes):
            where[t][a] = s
        total = np.array([self.counts[t][a] for t, a in nodes])
        parts = max(1, -(-m * 16 * max(f, n * k) // (8 << 20)))

        def extremes(batches):
            low, high = np.full((m, f), np.inf), np.full((m, f), -np.inf)
            for b in batches:
                x = _matrix(b.column("x"))
                for rows, slot in _slots(trees, where, x):
                    order = np.argsort(slot, kind="stable")
                    at, first = np.unique(slot[order], return_index=True)
                    own = x[rows[order]]
                    low[at] = np.minimum(low[at], np.fmin.reduceat(np.where(np.isnan(own), np.inf, own), first))
                    high[at] = np.maximum(high[at], np.fmax.reduceat(np.where(np.isnan(own), -np.inf, own), first))
            seen = np.flatnonzero((low <= high).any(1))
            yield _sent(seen, np.concatenate([low[seen], high[seen]], 1))

        def choose(batches):
            slot, sums = _received(batches, np.float64)
            if len(slot):
                at, first = _groups(slot)
                low, high = np.minimum.reduceat(sums[:, :f], first), np.maximum.reduceat(sums[:, f:], first)
                feature, cut = drawn_splits(seed, tree_of[at], node_of[at], low, high, n)
                yield _sent(at, np.concatenate([feature.astype(np.float64), cut], 1))

        def summed(own, then):
            return (self.rows.mapInArrow(own, "slot int, v binary").repartition(parts, "slot").sortWithinPartitions("slot")
                        .mapInArrow(then, "slot int, v binary").collect())

        feature, cut = np.full((m, n), LEAF), np.zeros((m, n))
        for r in summed(extremes, choose):
            v = np.frombuffer(r.v, np.float64)
            feature[r.slot], cut[r.slot] = v[:n].astype(np.int64), v[n:]

        def counts(batches):
            left = np.zeros((m, n, k), np.int64)
            for b in batches:
                x, y = _matrix(b.column("x")), b.column("y").to_numpy()
                for rows, slot in _slots(trees, where, x):
                    goes = ~(x[rows[:, None], feature[slot]] > cut[slot])
                    at, col_ = np.nonzero(goes)
                    place = (slot[at] * n + col_) * k + y[rows[at]]
                    found, times = np.unique(place, return_counts=True)
                    left.reshape(-1)[found] += times
            seen = np.flatnonzero(left.any((1, 2)))
            yield _sent(seen, left[seen].reshape(len(seen), n * k))

        def pick(batches):
            slot, sums = _received(batches, np.int64)
            if len(slot):
                at, first = _groups(slot)
                left = np.add.reduceat(sums, first).reshape(len(at), n, k)
                best = best_split(left, total[at], feature[at], min_leaf)
                at, left, best = at[best != LEAF], left[best != LEAF], best[best != LEAF]
                yield _sent(at, np.concatenate([best[:, None], left[np.arange(len(at)), best]], 1))

        for r in sorted(summed(counts, pick)):
            v = np.frombuffer(r.v, np.int64)
            t, node = nodes[r.slot]
            yield t, node, int(feature[r.slot, v[0]]), float(cut[r.slot, v[0]]), v[1:].copy()


def _sent(slots: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), pa.array([v.tobytes() for v in values], pa.binary())], ["slot", "v"])


def _received(batches, kind):
    """All (slot, numbers) of a partition, which holds a bounded part of a pass, sorted by slot."""
    slots, values = [], []
    for b in batches:
        slots += b.column("slot").to_pylist()
        values += b.column("v").to_pylist()
    return np.array(slots, np.int64), np.frombuffer(b"".join(values), kind).reshape(len(slots), -1) if slots else None


def _groups(slot: np.ndarray):
    return np.unique(slot, return_index=True)


class RandomTrees(_Stage, HasInputCol, HasOutputCol):
    """The fitted forest: features -> class probabilities (``array<double>``), the mean of the leaves' class shares. Savable."""

    model = _param("model", "trees and the class counts of their leaves, packed", TypeConverters.toString)

    @classmethod
    def of(cls, trees: list[Tree], counts: list[list[np.ndarray]], features_col: str, out: str) -> "RandomTrees":
        told = [{"feature": t.feature, "threshold": t.threshold, "left": t.left, "counts": [c.tolist() for c in own]}
                for t, own in zip(trees, counts)]
        return cls()._with(inputCol=features_col, outputCol=out,
                           model=base64.b64encode(zlib.compress(json.dumps(told).encode())).decode())

    def trees(self) -> list[tuple[Tree, np.ndarray]]:
        """(tree, class counts of its nodes) each."""
        told = json.loads(zlib.decompress(base64.b64decode(self.getOrDefault(self.model))))
        return [(Tree(t["feature"], t["threshold"], t["left"]), np.array(t["counts"], np.int64)) for t in told]

    def _transform(self, df: DataFrame) -> DataFrame:
        own = [(t, c / c.sum(1, keepdims=True)) for t, c in self.trees()]

        @F.pandas_udf("array<double>")
        def probabilities(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=object)
            values = np.stack([np.asarray(v, np.float64) for v in x])
            return pd.Series(list(sum(shares[t.nodes(values)] for t, shares in own) / len(own)))

        x = F.transform(as_array(df, self.getInputCol()), lambda v: F.coalesce(v, F.lit(float("nan"))))
        return df.withColumn(self.getOutputCol(), probabilities(x))


def fit_random_trees(train: DataFrame, n_classes: int, num_trees: int = 100, max_depth: int | None = None, min_leaf: int = 1,
                     features: int | None = None, seed: int = 42, label_col: str = "label_idx", features_col: str = "features",
                     out: str = "probability_arr") -> RandomTrees:
    """M6: the fitted stage. ``features`` drawn per node, the root of their number
    if not given; depth without limit unless one is given. Trees of unlimited
    depth have a leaf for every few rows, and the model is one object: on large
    data set ``min_leaf`` in proportion to the rows."""
    forest = _Forest(train, n_classes, label_col, features_col, num_trees, max_depth, min_leaf, features, seed)
    forest.grow()
    return RandomTrees.of(forest.trees, forest.counts, features_col, out)
