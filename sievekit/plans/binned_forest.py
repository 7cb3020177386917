"""M1, M6: forests on binned features whose deep nodes cost what their rows cost.

The features are cut at up to ``maxBins - 1`` quantiles (all values of a feature
with fewer), rows with equal bins and label become one with their number, and the
trees look at bins only. Levels of large nodes are done for all trees at once, by
sums of class counts per (node, drawn feature, bin), which the summing task turns
into splits. Nodes of at most ``LOCAL_ROWS`` rows are settled last: their rows go
once to the task that grows all below them, so no dense sums are shipped for the
many small nodes of a deep tree.

The split is the drawn features' best by Gini; a node without gain is a leaf.
With ``bootstrap`` a row of number n counts Poisson(n) times in a tree. Draws are
hashes of (seed, tree, node, feature) or (seed, tree, row): the model depends on
the rows and the seed alone, not on how they lie. A missing value goes right.

A model of up to ``MODEL_NODES`` nodes, as far as its rows and depth tell, is one object
and scores row by row. A larger one stays in the shared folder in parts of that size;
the driver keeps the trees' upper levels, down to the nodes that tasks grow. To score,
the table is written once, each row goes to the parts that hold one of its leaves, and
the parts' sums are joined back to it.
"""

from __future__ import annotations

import base64
import io
import math
import sys
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import Estimator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import TypeConverters
from pyspark.ml.param.shared import (HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol,
                                     HasSeed)
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievekit.functions.names import col
from sievekit.functions.vectors import argmax_first
from sievekit.plans.random_trees import LEAF, _matrix, draw
from sievekit.plans.stages import _param, _Stage, as_array
from sievekit.session import work_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])     # tasks need no installed package

LOCAL_ROWS = 4096           # of a node whose subtree one task grows, at most
PASS_BYTES = 64 << 20       # of sums in a task
PARTITIONS = 8              # of the binned rows, at least
PART_ROWS = 250_000         # of such a partition, at most (about)
SENT_ROWS = 100_000         # of small nodes, in the partition that grows them (about)
MODEL_NODES = 1 << 21       # of a model's part, at most (about)
SCORE_ROWS = 1024           # of a block sent to a part
UNIT = float(1 << 40)       # shares are summed over parts as whole numbers: in any order the same


def bin_edges(rows: DataFrame, n_features: int, bins: int) -> list[np.ndarray]:
    """Per feature of ``x`` the ascending thresholds: its values but the largest
    if there are at most ``bins``, else quantiles."""
    x = [F.nanvl(F.get("x", F.lit(i)), F.lit(None).cast("double")) for i in range(n_features)]
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    told = rows.agg(*[F.struct(F.approx_count_distinct(c).alias("n"), F.percentile_approx(c, shares).alias("q")).alias(f"f{i}")
                      for i, c in enumerate(x)]).first()
    few = [i for i in range(n_features) if told[i].n <= 2 * bins]
    values = rows.agg(*[F.collect_set(x[i]).alias(f"f{i}") for i in few]).first() if few else []
    out = [np.unique(np.array(told[i].q or [], np.float64)) for i in range(n_features)]
    for i, own in zip(few, values):
        if len(own) <= bins:
            out[i] = np.sort(np.array(own, np.float64))[:-1]
    return out


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """The number of thresholds below each value; a missing value is in the last bin."""
    out = np.empty(x.shape, np.uint8)
    for i, e in enumerate(edges):
        out[:, i] = np.searchsorted(e, x[:, i], "left")
    return out


def poisson_weights(keys: np.ndarray, n: np.ndarray, trees: int, seed: int) -> np.ndarray:
    """How often each row counts in each tree."""
    steps = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(20)])
    tree, node = np.arange(trees)[None, :], np.zeros((1, 1), np.int64)
    out = np.searchsorted(steps, draw(seed, tree, keys[:, None], node, 2), "right").astype(np.int32)
    for i in np.flatnonzero(n > 1):
        out[i] = np.random.default_rng([seed % (1 << 64), int(keys[i]) % (1 << 64)]).poisson(n[i], trees)
    return out


def drawn_features(seed: int, tree, path, n_features: int, n: int) -> np.ndarray:
    """Per node the ``n`` features looked at."""
    order = draw(seed, np.asarray(tree)[:, None], np.asarray(path)[:, None], np.arange(n_features)[None, :], 0)
    return np.argsort(order, 1, kind="stable")[:, :n]


def _score(counts: np.ndarray) -> np.ndarray:
    return (counts.astype(np.float64) ** 2).sum(-1) / np.maximum(counts.sum(-1), 1)


def _gains(score: np.ndarray, total: np.ndarray) -> np.ndarray:
    return score > _score(total) * (1 + 1e-12)


def _depth(path: np.ndarray) -> np.ndarray:
    """Nodes are numbered as in a heap: the root is 1, the children of p are 2p and 2p + 1."""
    return np.frexp(np.asarray(path, np.float64))[1] - 1


class Walk:
    """A tree in the making: where its rows lie. ``splits``: node -> (feature, last bin that goes left)."""

    def __init__(self, splits: dict[int, tuple[int, int]], slots: dict[int, int]):
        self.path = path = np.array(sorted({1, *splits, *(2 * p for p in splits), *(2 * p + 1 for p in splits)}), np.int64)
        own = [splits.get(p, (LEAF, 0)) for p in path.tolist()]
        self.feature, self.cut = np.array([f for f, _ in own]), np.array([c for _, c in own])
        self.left = np.searchsorted(path, 2 * path)
        self.slot = np.array([slots.get(p, -1) for p in path.tolist()])

    def slots(self, bins: np.ndarray) -> np.ndarray:
        return self.slot[_leaves(self.feature, self.cut, self.left, bins)]


def _leaves(feature: np.ndarray, cut: np.ndarray, left: np.ndarray, bins: np.ndarray) -> np.ndarray:
    node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
    while len(rows):
        rows = rows[feature[node[rows]] != LEAF]
        at = node[rows]
        node[rows] = left[at] + (bins[rows, feature[at]] > cut[at])
    return node


def grow_below(y, w, bins, node, tree, path, k: int, n: int, size: int, seed: int, max_depth: int, min_leaf: int):
    """Grows all below the nodes (``tree``, ``path``); ``node`` is each row's among
    them. Yields (tree, path, feature, cut, class, rows) arrays: a split with
    class -1, a leaf with feature LEAF once per class it has."""
    while len(tree):
        m = len(tree)
        counts = np.rint(np.bincount(node * k + y, w, m * k)).astype(np.int64).reshape(m, k)
        open_ = (np.count_nonzero(counts, 1) > 1) & (counts.sum(1) >= 2 * min_leaf) & (_depth(path) < max_depth)
        feature, cut = np.full(m, LEAF), np.zeros(m, np.int64)
        at = np.flatnonzero(open_)
        rows = np.flatnonzero(open_[node])
        if len(at):
            number = np.cumsum(open_) - 1
            own = number[node[rows]]
            chosen = drawn_features(seed, tree[at], path[at], bins.shape[1], n)
            key = ((own[:, None] * n + np.arange(n)) * size + bins[rows[:, None], chosen[own]]).ravel()
            order = np.argsort(key, kind="stable")
            key, row = key[order], rows[order // n]
            left = np.zeros((len(key), k), np.int64)
            left[np.arange(len(key)), y[row]] = w[row]
            np.cumsum(left, 0, out=left)
            group = key // size
            begins = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            before = np.concatenate([np.zeros((1, k), np.int64), left])[begins]
            last = np.flatnonzero((key[1:] != key[:-1]) & (group[1:] == group[:-1]))
            if len(last):
                left = left[last] - before[group[last]]         # every (node, feature) has rows
                owner = group[last] // n
                total = counts[at][owner]
                right = total - left
                score = _score(left) + _score(right)
                score[(left.sum(1) < min_leaf) | (right.sum(1) < min_leaf)] = -1.0
                first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                top = np.maximum.reduceat(score, first)
                best = np.flatnonzero(score == np.repeat(top, np.diff(np.r_[first, len(score)])))
                best = best[np.r_[True, owner[best][1:] != owner[best][:-1]]]
                best = best[_gains(score[best], total[best])]
                to = owner[best]
                feature[at[to]] = chosen[to, group[last[best]] % n]
                cut[at[to]] = key[last[best]] % size
        split = feature != LEAF
        s = np.flatnonzero(split)
        yield tree[s], path[s], feature[s], cut[s], np.full(len(s), -1), np.zeros(len(s), np.int64)
        leaf, cls = np.nonzero(counts * ~split[:, None])
        yield tree[leaf], path[leaf], np.full(len(leaf), LEAF), np.zeros(len(leaf), np.int64), cls, counts[leaf, cls]
        rows = np.flatnonzero(split[node])
        up = node[rows]
        y, w, bins = y[rows], w[rows], bins[rows]
        right = bins[np.arange(len(rows)), feature[up]] > cut[up]
        node = 2 * (np.cumsum(split) - 1)[up] + right
        tree, path = np.repeat(tree[s], 2), np.ravel(np.stack([2 * path[s], 2 * path[s] + 1], 1))


def _grouped(batches):
    """(slot, values) of a partition sorted by slot, one slot at a time."""
    slot, values = None, []
    for b in batches:
        for s, v in zip(b.column("slot").to_pylist(), b.column("v").to_pylist()):
            if s != slot and values:
                yield slot, values
                values = []
            slot = s
            values.append(v)
    if values:
        yield slot, values


def _sent(slots, values: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), pa.array(values, pa.binary())], ["slot", "v"])


#: A split with class -1, or a leaf with feature LEAF once per class it has.
NODE = np.dtype([("tree", "<i4"), ("path", "<i8"), ("feature", "<i2"), ("cut", "u1"), ("cls", "<i2"), ("n", "<i8")])


class _Growth:
    def __init__(self, train: DataFrame, label_col: str, features_col: str, trees: int, max_depth: int, min_leaf: int,
                 strategy: str, bootstrap: bool, bins: int, seed: int):
        self.spark, self.t, self.max_depth, self.min_leaf, self.seed = train.sparkSession, trees, max_depth, min_leaf, seed
        rows = train.select(col(label_col).cast("int").alias("y"), as_array(train, features_col).alias("x"))
        told = rows.agg(F.count(F.lit(1)).alias("n"), F.count("y").alias("labelled"), F.max("y").alias("top"),
                        F.max(F.size("x")).alias("f")).first()
        if not told.n:
            raise ValueError("no rows to fit")
        if told.labelled < told.n:
            raise ValueError("labels must not be null")
        self.k, self.f, self.size, self.bootstrap = told.top + 1, told.f, bins, bootstrap
        self.n = _drawn(strategy, self.f)
        self.edges = bin_edges(rows, self.f, bins)
        self.rows = self._stored(rows, told.n)

    def _stored(self, rows: DataFrame, n: int) -> DataFrame:
        edges, bootstrap, trees, seed = self.edges, self.bootstrap, self.t, self.seed

        def cut(batches):
            for b in batches:
                own = binned(_matrix(b.column("x")), edges)
                yield pa.RecordBatch.from_arrays([b.column("y"), pa.array([r.tobytes() for r in own], pa.binary())], ["y", "b"])

        def weigh(batches):
            for b in batches:
                y, own, n = b.column("y").to_numpy(), b.column("b").to_pylist(), b.column("n").to_numpy()
                keys = np.array([int.from_bytes(blake2b(v + int(c).to_bytes(4, "little"), digest_size=8).digest(), "little")
                                 for v, c in zip(own, y)], np.uint64)
                w = poisson_weights(keys, n, trees, seed) if bootstrap else n.astype(np.int32)[:, None]
                yield pa.RecordBatch.from_arrays([b.column("y"), b.column("b"), pa.array([v.tobytes() for v in w], pa.binary())],
                                                 ["y", "b", "w"])

        schema = "y int, b binary, w binary"
        path = work_dir(self.spark, "bins")
        (rows.mapInArrow(cut, "y int, b binary").groupBy("y", "b").agg(F.count(F.lit(1)).alias("n"))
             .repartition(max(PARTITIONS, math.ceil(n / PART_ROWS)), "y", "b").mapInArrow(weigh, schema).write.parquet(path))
        return self.spark.read.schema(schema).parquet(path)

    def _reader(self):
        """Batch -> labels, bins (rows x features), weights (rows x trees, or one column for all)."""
        f = self.f

        def read(b):
            own = np.frombuffer(b"".join(b.column("b").to_pylist()), np.uint8).reshape(-1, f)
            w = np.frombuffer(b"".join(b.column("w").to_pylist()), np.int32).reshape(len(own), -1)
            return b.column("y").to_numpy(), own, w
        return read

    def grow(self) -> dict:
        """The model: its text and, if it has parts, their number and folder."""
        read, k, t = self._reader(), self.k, self.t

        def roots(batches):
            sums = np.zeros((k, t), np.int64)
            for b in batches:
                y, _, w = read(b)
                for c in range(k):
                    sums[c] += w[y == c].sum(0)
            yield _sent([0], [sums.tobytes()])

        found = self.rows.mapInArrow(roots, "slot int, v binary").collect()
        sums = sum(np.frombuffer(r.v, np.int64).reshape(k, t) for r in found).T
        self.splits = [{} for _ in range(t)]
        nodes, small, out = [], [], []

        def place(tree: int, path: int, counts: np.ndarray):
            total = int(counts.sum())
            if np.count_nonzero(counts) > 1 and total >= 2 * self.min_leaf and path.bit_length() - 1 < self.max_depth:
                (nodes if total > LOCAL_ROWS else small).append((tree, path, counts))
            else:
                out.extend((tree, path, LEAF, 0, c, int(counts[c])) for c in np.flatnonzero(counts))

        for tree in range(t):
            place(tree, 1, sums[tree])
        size = max(1, PASS_BYTES // (8 * self.n * self.size * k))
        while nodes:
            level, nodes = nodes, []
            done = [s for i in range(0, len(level), size) for s in self.level(level[i:i + size])]
            for (tree, path, counts), best in zip(level, done):
                if best is None:
                    out.extend((tree, path, LEAF, 0, c, int(counts[c])) for c in np.flatnonzero(counts))
                else:
                    feature, cut, left = best
                    self.splits[tree][path] = feature, cut
                    out.append((tree, path, feature, cut, -1, 0))
                    place(tree, 2 * path, left)
                    place(tree, 2 * path + 1, counts - left)
        small.sort(key=lambda s: s[:2])
        leaves = [o for o in out if o[2] == LEAF]
        units: dict[tuple[int, int], int] = {}                  # where the driver's levels end -> nodes from there down, at most
        for tree, path, counts in small:
            total = int(counts.sum())
            most = max(1, min(total // max(1, self.min_leaf), 1 << (self.max_depth - path.bit_length() + 1)))
            units[tree, path] = most + min(total, k * most)
        for o in leaves:
            units[o[:2]] = units.get(o[:2], 0) + 1
        part_of, before = {}, 0
        for unit in sorted(units):
            part_of[unit] = before // MODEL_NODES
            before += units[unit]
        parts = max(part_of.values()) + 1
        if parts == 1:
            nodes = [np.array(out, NODE)]
            if small:
                nodes += [np.frombuffer(r.v, NODE) for r in self.below(small, [0] * len(small)).collect()]
            return {"model": packed(self.edges, np.concatenate(nodes), t, k)}
        table, own = work_dir(self.spark, "trees"), {}
        for o in leaves:
            own.setdefault(part_of[o[:2]], []).append(o)
        if small:
            self.below(small, [part_of[s[:2]] for s in small]).write.parquet(table)
        if own:
            self.spark.createDataFrame([(p, np.array(v, NODE).tobytes()) for p, v in own.items()], PART).write.mode("append").parquet(table)
        tops = [Walk(self.splits[tree], {}) for tree in range(t)]
        for tree, walk in enumerate(tops):
            walk.slot = np.array([part_of.get((tree, p), -1) for p in walk.path.tolist()])
        return {"model": _tops_text(self.edges, tops, k), "parts": parts, "table": table}

    def walks(self, nodes) -> dict[int, Walk]:
        slots = {}
        for s, (tree, path, _) in enumerate(nodes):
            slots.setdefault(tree, {})[path] = s
        return {tree: Walk(self.splits[tree], own) for tree, own in slots.items()}

    def level(self, nodes: list[tuple[int, int, np.ndarray]]):
        """Per node its split (feature, cut, class counts left of it) or None."""
        read, k, n, size, min_leaf, m = self._reader(), self.k, self.n, self.size, self.min_leaf, len(nodes)
        walks = self.walks(nodes)
        tree_of = np.array([t for t, _, _ in nodes])            # ascending: a tree's slots lie together
        chosen = drawn_features(self.seed, tree_of, np.array([p for _, p, _ in nodes]), self.f, n)
        parts = max(1, -(-m * 8 * n * size * k // (8 << 20)))

        def counts(batches):
            sums = np.zeros((m, n * size * k), np.int64)
            for b in batches:
                y, bins, w = read(b)
                for t, walk in walks.items():
                    slot = walk.slots(bins)
                    rows = np.flatnonzero(slot >= 0)
                    own = w[rows, t if w.shape[1] > 1 else 0]
                    a, z = np.searchsorted(tree_of, [t, t + 1])
                    at = slot[rows]
                    place = (((at - a)[:, None] * n + np.arange(n)) * size + bins[rows[:, None], chosen[at]]) * k + y[rows][:, None]
                    sums[a:z] += np.rint(np.bincount(place.ravel(), np.repeat(own, n), (z - a) * n * size * k)).astype(np.int64).reshape(z - a, -1)
            seen = np.flatnonzero(sums.any(1))
            yield _sent(seen, [v.tobytes() for v in sums[seen]])

        def pick(batches):
            for s, values in _grouped(batches):
                left = np.cumsum(sum(np.frombuffer(v, np.int64) for v in values).reshape(n, size, k), 1)
                total = left[0, -1]
                right = total - left
                score = _score(left) + _score(right)
                score[(left.sum(2) < max(1, min_leaf)) | (right.sum(2) < max(1, min_leaf))] = -1.0
                j, cut = np.unravel_index(score.argmax(), score.shape)
                if _gains(score[j, cut], total):
                    yield _sent([s], [np.r_[chosen[s, j], cut, left[j, cut]].astype(np.int64).tobytes()])

        out = [None] * m
        for r in (self.rows.mapInArrow(counts, "slot int, v binary").repartition(parts, "slot").sortWithinPartitions("slot")
                      .mapInArrow(pick, "slot int, v binary").collect()):
            v = np.frombuffer(r.v, np.int64)
            out[r.slot] = int(v[0]), int(v[1]), v[2:].copy()
        return out

    def below(self, nodes: list[tuple[int, int, np.ndarray]], part_of: list[int]) -> DataFrame:
        """All nodes from these small ones down, with the part each belongs to."""
        read, k, n, size, f, seed = self._reader(), self.k, self.n, self.size, self.f, self.seed
        max_depth, min_leaf, walks = self.max_depth, self.min_leaf, self.walks(nodes)
        tree_of, path_of = np.array([t for t, _, _ in nodes]), np.array([p for _, p, _ in nodes], np.int64)
        kind = np.dtype([("y", "<i4"), ("w", "<i4"), ("b", "u1", (f,))])
        rows_of = sum(int(c.sum()) for _, _, c in nodes)
        parts = max(PARTITIONS, -(-rows_of // SENT_ROWS))

        def deal(batches):
            for b in batches:
                y, bins, w = read(b)
                for t, walk in walks.items():
                    slot, own = walk.slots(bins), w[:, t if w.shape[1] > 1 else 0]
                    rows = np.flatnonzero((slot >= 0) & (own > 0))
                    rows = rows[np.argsort(slot[rows], kind="stable")]
                    packed = np.empty(len(rows), kind)
                    packed["y"], packed["w"], packed["b"] = y[rows], own[rows], bins[rows]
                    at, first = np.unique(slot[rows], return_index=True)
                    yield _sent(at, [v.tobytes() for v in np.split(packed, first[1:])] if len(at) else [])

        def grown(slots, values):
            own = [np.frombuffer(b"".join(v), kind) for v in values]
            node = np.repeat(np.arange(len(own)), [len(v) for v in own])
            own, slots = np.concatenate(own), np.array(slots)
            columns = zip(*grow_below(own["y"].astype(np.int64), own["w"].astype(np.int64), own["b"], node, tree_of[slots],
                                      path_of[slots], k, n, size, seed, max_depth, min_leaf))
            columns = [np.concatenate(c) for c in columns]
            out = np.empty(len(columns[0]), NODE)
            for name, c in zip(NODE.names, columns):
                out[name] = c
            return pa.RecordBatch.from_arrays([pa.array([part_of[slots[0]]], pa.int32()), pa.array([out.tobytes()], pa.binary())], ["part", "v"])

        def grow(batches):
            slots, values, held = [], [], 0
            for s, v in _grouped(batches):
                if slots and (held >= LOCAL_ROWS or part_of[s] != part_of[slots[0]]):
                    yield grown(slots, values)
                    slots, values, held = [], [], 0
                slots.append(s), values.append(v)
                held += sum(map(len, v)) // kind.itemsize
            if slots:
                yield grown(slots, values)

        return (self.rows.mapInArrow(deal, "slot int, v binary").repartition(parts, "slot").sortWithinPartitions("slot")
                    .mapInArrow(grow, PART))


def _drawn(strategy: str, f: int) -> int:
    if strategy in ("auto", "sqrt"):
        return max(1, math.ceil(math.sqrt(f)))
    if strategy == "log2":
        return max(1, math.ceil(math.log2(f)))
    if strategy == "onethird":
        return max(1, math.ceil(f / 3))
    if strategy == "all":
        return f
    return min(f, max(1, int(strategy) if strategy.isdigit() else math.ceil(float(strategy) * f)))


def assembled(nodes: np.ndarray):
    """A tree's nodes in heap order: feature, cut, left child, number of entries; and the entries' class and share."""
    nodes = nodes[np.lexsort((nodes["cls"], nodes["path"]))]
    own, first, times = np.unique(nodes["path"], return_index=True, return_counts=True)
    feature, entry = nodes["feature"][first], nodes["cls"] >= 0
    left = np.where(feature == LEAF, 0, np.searchsorted(own, 2 * own)).astype(np.int32)
    share = nodes["n"] / np.maximum(np.repeat(np.add.reduceat(nodes["n"], first), times), 1)
    return (feature, nodes["cut"][first], left, np.add.reduceat(entry.astype(np.int16), first, dtype=np.int16), nodes["cls"][entry], share[entry])


def _text(arrays: dict, edges: list[np.ndarray]) -> str:
    file = io.BytesIO()
    np.savez_compressed(file, **arrays, edges=np.concatenate(edges) if edges else np.zeros(0), n_edges=np.array([len(e) for e in edges]))
    return base64.b64encode(file.getvalue()).decode()


def packed(edges: list[np.ndarray], nodes: np.ndarray, trees: int, k: int) -> str:
    """The model as text: edges, and per tree its nodes in heap order, where leaves point into a list of (class, share)."""
    nodes = nodes[np.argsort(nodes["tree"], kind="stable")]
    bounds = np.searchsorted(nodes["tree"], np.arange(trees + 1))
    feature, cut, left, entries, cls, share = zip(*(assembled(nodes[a:z]) for a, z in zip(bounds, bounds[1:])))
    return _text({"k": np.array(k), "size": np.array([len(v) for v in feature]), "feature": np.concatenate(feature), "cut": np.concatenate(cut),
                  "left": np.concatenate(left), "entries": np.concatenate(entries), "cls": np.concatenate(cls),
                  "share": np.concatenate(share)}, edges)


class Trees:
    """Trees in heap order, for scoring."""

    def __init__(self, k: int, edges: list[np.ndarray], trees: list, cls: np.ndarray, share: np.ndarray):
        """``trees``: (feature, cut, left child, first entry, number of entries)."""
        self.k, self.edges, self.trees, self.cls, self.share = k, edges, trees, cls, share

    @classmethod
    def load(cls, text: str) -> "Trees":
        with np.load(io.BytesIO(base64.b64decode(text))) as m:
            entries, at = m["entries"].astype(np.int64), np.cumsum(m["size"])[:-1]
            trees = list(zip(*(np.split(m[name], at) for name in ("feature", "cut", "left")),
                             np.split(np.cumsum(entries) - entries, at), np.split(entries, at)))
            return cls(int(m["k"]), np.split(m["edges"], np.cumsum(m["n_edges"])[:-1]), trees, m["cls"].astype(np.int64), m["share"])

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Per row the sum over the trees of its leaf's class shares; equal binned rows are scored once."""
        bins = binned(x, self.edges)
        bins, back = np.unique(bins, axis=0, return_inverse=True) if bins.shape[1] <= 8 else (bins, np.arange(len(bins)))
        return self.sums(bins)[back.ravel()]

    def sums(self, bins: np.ndarray) -> np.ndarray:
        out = np.zeros(len(bins) * self.k)
        for feature, cut, left, begin, entries in self.trees:
            leaf = _leaves(feature, cut, left, bins)
            times = entries[leaf]
            row = np.repeat(np.arange(len(bins)), times)
            entry = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(begin[leaf], times)
            out += np.bincount(row * self.k + self.cls[entry], self.share[entry], len(out))
        return out.reshape(-1, self.k)


PART = "part int, v binary"


def _tops_text(edges: list[np.ndarray], tops: list[Walk], k: int) -> str:
    columns = {name: np.concatenate([getattr(w, name) for w in tops]) for name in ("path", "feature", "cut", "left", "slot")}
    return _text({"k": np.array(k), "size": np.array([len(w.path) for w in tops]), **columns}, edges)


class Tops:
    """The upper levels of a model in parts: its trees down to the nodes whose part is known."""

    def __init__(self, text: str):
        with np.load(io.BytesIO(base64.b64decode(text))) as m:
            self.k, self.edges, at = int(m["k"]), np.split(m["edges"], np.cumsum(m["n_edges"])[:-1]), np.cumsum(m["size"])[:-1]
            self.trees = list(zip(*(np.split(m[name], at) for name in ("path", "feature", "cut", "left", "slot"))))

    def parts(self, bins: np.ndarray, n: int) -> np.ndarray:
        """Whether a part (row) holds a leaf of a row (column)."""
        out = np.zeros((n, len(bins)), bool)
        for _, feature, cut, left, part in self.trees:
            out[part[_leaves(feature, cut, left, bins)], np.arange(len(bins))] = True
        return out

    def below(self, nodes: np.ndarray) -> Trees:
        """The trees of a part; where they leave it they end in nothing."""
        nodes = nodes[np.argsort(nodes["tree"], kind="stable")]
        trees, entries = [], 0
        classes, shares = [], []
        for tree in np.unique(nodes["tree"]).tolist():
            own = nodes[slice(*np.searchsorted(nodes["tree"], [tree, tree + 1]))]
            path, feature, cut, _, _ = self.trees[tree]
            upper = np.flatnonzero(~np.isin(path, own["path"]))
            top = np.zeros(len(upper), NODE)
            top["path"], top["feature"], top["cut"], top["cls"] = path[upper], feature[upper], cut[upper], -1
            feature, cut, left, times, cls, share = assembled(np.concatenate([top, own]))
            times = times.astype(np.int64)
            trees.append((feature, cut, left, entries + np.cumsum(times) - times, times))
            entries += len(cls)
            classes.append(cls), shares.append(share)
        return Trees(self.k, self.edges, trees, np.concatenate(classes).astype(np.int64), np.concatenate(shares))


class _Writer(DefaultParamsWriter):
    """A model's parts go with it."""

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        model = self.instance
        if model.getOrDefault(model.parts) > 1:
            self.sparkSession.read.schema(PART).parquet(model.getOrDefault(model.table)).write.parquet(f"{path}/parts")


class _Reader(DefaultParamsReader):
    def load(self, path: str):
        model = super().load(path)
        return model._set(table=f"{path}/parts") if model.getOrDefault(model.parts) > 1 else model


class BinnedForestModel(_Stage, HasFeaturesCol, HasRawPredictionCol, HasProbabilityCol, HasPredictionCol):
    """The fitted forest. Savable."""

    model = _param("model", "edges and trees, packed; of a model in parts their upper levels", TypeConverters.toString)
    trees = _param("trees", "their number", TypeConverters.toInt)
    parts = _param("parts", "in how many parts the trees are, 0 if in none", TypeConverters.toInt)
    table = _param("table", "folder of the parts", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(parts=0, table="")

    def write(self):
        return _Writer(self)

    @classmethod
    def read(cls):
        return _Reader(cls)

    def _transform(self, df: DataFrame) -> DataFrame:
        df = self._by_parts(df) if self.getOrDefault(self.parts) > 1 else self._by_row(df)
        told, probs = self.getRawPredictionCol(), self.getProbabilityCol()
        n = self.getOrDefault(self.trees)
        df = df.withColumn("_shares", F.transform("_raw", lambda v: v / n))
        index, _ = argmax_first("_shares")
        return df.withColumns({told: array_to_vector("_raw"), probs: array_to_vector("_shares"),
                               self.getPredictionCol(): index.cast("double")}).drop("_raw", "_shares")

    def _by_row(self, df: DataFrame) -> DataFrame:
        text, own = self.getOrDefault(self.model), []

        @F.arrow_udf("array<double>")
        def raw(x: pa.Array) -> pa.Array:
            if not own:
                own.append(Trees.load(text))
            got = own[0].raw(_matrix(x)) if len(x) else np.zeros((0, 1))
            return pa.ListArray.from_arrays(pa.array(np.arange(len(got) + 1) * got.shape[1], pa.int32()), pa.array(got.ravel()))

        return df.withColumn("_raw", raw(as_array(df, self.getFeaturesCol())))

    def _by_parts(self, df: DataFrame) -> DataFrame:
        spark, text, parts, path = df.sparkSession, self.getOrDefault(self.model), self.getOrDefault(self.parts), work_dir(df.sparkSession, "toscore")
        k = Tops(text).k
        df = df.withColumn("_row", F.monotonically_increasing_id())
        df.write.parquet(path)
        df = spark.read.schema(df.schema).parquet(path)

        def deal(batches):
            tops = Tops(text)
            for b in batches:
                for a in range(0, b.num_rows, SCORE_ROWS):
                    block = b.slice(a, SCORE_ROWS)
                    bins = binned(_matrix(block.column("x")), tops.edges)
                    own = np.empty(len(bins), [("row", "<i8"), ("b", "u1", (bins.shape[1],))])
                    own["row"], own["b"] = block.column("_row").to_numpy(), bins
                    hit = tops.parts(bins, parts)
                    to = np.flatnonzero(hit.any(1))
                    yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(np.full(len(to), 1), pa.int32()),
                                                      pa.array([own[hit[p]].tobytes() for p in to], pa.binary())], ["part", "kind", "v"])

        def score(batches):
            tops, nodes, trees = Tops(text), [], None
            kind = np.dtype([("row", "<i8"), ("b", "u1", (len(tops.edges),))])
            for b in batches:
                for which, v in zip(b.column("kind").to_pylist(), b.column("v").to_pylist()):
                    if not which:
                        nodes.append(v)
                        continue
                    if trees is None:
                        trees = tops.below(np.frombuffer(b"".join(nodes), NODE))
                        nodes = []
                    own = np.frombuffer(v, kind)
                    got = np.rint(trees.sums(np.ascontiguousarray(own["b"])) * UNIT).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(own["row"]), *[pa.array(c) for c in got.T]], ["_row", *[f"c{i}" for i in range(k)]])

        model = spark.read.schema(PART).parquet(self.getOrDefault(self.table)).select("part", F.lit(0).alias("kind"), "v")
        rows = df.select("_row", as_array(df, self.getFeaturesCol()).alias("x")).mapInArrow(deal, "part int, kind int, v binary")
        sums = (model.unionAll(rows).repartitionById(parts, F.col("part")).sortWithinPartitions("kind")
                     .mapInArrow(score, "_row long, " + ", ".join(f"c{i} long" for i in range(k)))
                     .groupBy("_row").agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(k)])
                     .select("_row", F.array(*[F.col(f"c{i}") / F.lit(UNIT) for i in range(k)]).alias("_raw")))
        return df.join(sums, "_row", "left").drop("_row")


class BinnedForest(Estimator, HasFeaturesCol, HasLabelCol, HasRawPredictionCol, HasProbabilityCol, HasPredictionCol, HasSeed):
    """A classification forest with the parameters of Spark's."""

    numTrees = _param("numTrees", "trees", TypeConverters.toInt)
    maxDepth = _param("maxDepth", "levels below the root", TypeConverters.toInt)
    maxBins = _param("maxBins", "bins of a feature, at most 256", TypeConverters.toInt)
    minInstancesPerNode = _param("minInstancesPerNode", "fewest rows of a leaf", TypeConverters.toInt)
    featureSubsetStrategy = _param("featureSubsetStrategy", "features drawn per node", TypeConverters.toString)
    bootstrap = _param("bootstrap", "whether a tree draws its rows", TypeConverters.toBoolean)

    def __init__(self, **values):
        super().__init__()
        self._setDefault(numTrees=20, maxDepth=5, maxBins=32, minInstancesPerNode=1, featureSubsetStrategy="auto", bootstrap=True)
        self._set(**values)

    def getMaxDepth(self) -> int:
        return self.getOrDefault(self.maxDepth)

    def setRawPredictionCol(self, name: str) -> "BinnedForest":
        return self._set(rawPredictionCol=name)

    def setProbabilityCol(self, name: str) -> "BinnedForest":
        return self._set(probabilityCol=name)

    def setPredictionCol(self, name: str) -> "BinnedForest":
        return self._set(predictionCol=name)

    def _fit(self, train: DataFrame) -> BinnedForestModel:
        get = self.getOrDefault
        if not 2 <= get(self.maxBins) <= 256:
            raise ValueError("maxBins is 2 to 256")
        growth = _Growth(train, self.getLabelCol(), self.getFeaturesCol(), get(self.numTrees), get(self.maxDepth),
                         get(self.minInstancesPerNode), get(self.featureSubsetStrategy), get(self.bootstrap), get(self.maxBins),
                         self.getSeed())
        return BinnedForestModel()._with(**growth.grow(), trees=get(self.numTrees),
                                         featuresCol=self.getFeaturesCol(), rawPredictionCol=self.getRawPredictionCol(),
                                         probabilityCol=self.getProbabilityCol(), predictionCol=self.getPredictionCol())
