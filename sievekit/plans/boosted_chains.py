"""One-vs-rest boosting as chains of trees, each chain in one task.

A class's trees follow one another, but the chains of different classes, folds
and trials don't touch: a search is as many tasks as it has chains, and no Spark
job per tree level. The table travels as bin numbers, a byte per feature; a task
holds it once and nothing goes through the driver but the fitted trees. A table
of more than ``CHAIN_ROWS`` rows is left to Spark's own boosting, level by level
(:meth:`BoostedChains.library`).

The trees are those of ``GBTClassifier``: labels are -1 and 1, the first tree
fits them, each further one fits 4y / (1 + exp(2yF)) and counts ``stepSize``;
splits by variance on features drawn per node, ``minInfoGain`` and
``minInstancesPerNode`` as there. A missing value goes right.

A histogram cell holds rows and residuals in one whole number, so a level is one
pass over the smaller children; the larger ones are differences. Draws are seeded
by class, round and node: the model doesn't depend on how classes are dealt to tasks.
"""

from __future__ import annotations

import base64
import io
import math
import sys
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import Estimator
from pyspark.ml.classification import GBTClassifier, OneVsRest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasRawPredictionCol, HasSeed
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievekit.functions.names import col
from sievekit.functions.vectors import argmax_first
from sievekit.operators.evaluation import per_model_scores
from sievekit.plans.binned_forest import _drawn, _leaves, bin_edges, binned, drawn_features
from sievekit.plans.random_trees import LEAF, _matrix
from sievekit.plans.stages import _param, _Stage, as_array
from sievekit.session import work_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])     # tasks need no installed package

CHAIN_ROWS = 1 << 19        # of a table whose chains grow in one task each, at most
GROUP_ROWS = 8192           # rows x classes of a task that grows several classes, at most (about)
DEAL_ROWS = 4096            # of a block that is sent
DEAL_SLOTS = 64             # to which it is sent at once
CELLS = 1 << 15             # of a histogram that are filled or searched at once (about): a core's cache holds them
BINS = 32


@dataclass(frozen=True)
class Chain:
    rounds: int
    rate: float
    depth: int
    min_leaf: int
    subsample: float
    features: int           # drawn per node
    min_gain: float
    seed: int


def _histograms(bins: np.ndarray, rows: np.ndarray, slot: np.ndarray, cell: np.ndarray, m: int, size: int) -> np.ndarray:
    """Sums of ``cell`` per (slot, feature, bin); ``slot`` ascends."""
    f = bins.shape[1]
    out, offset = np.zeros((m, f * size)), size * np.arange(f)
    step = max(1, CELLS // f)
    for a in range(0, len(rows), step):
        own = slot[a:a + step]
        lo, hi = own[0], own[-1] + 1
        at = bins[rows[a:a + step]] + (offset if hi - lo == 1 else offset + ((own - lo) * (f * size))[:, None])
        out[lo:hi] += np.bincount(at.ravel(), np.repeat(cell[a:a + step], f), (hi - lo) * f * size).reshape(hi - lo, -1)
    return out


def _best(hist: np.ndarray, shift: float, allowed: np.ndarray, size: int, min_leaf: int):
    """Per node (score of the best split, its feature, its last bin on the left, score of no split, rows)."""
    out = []
    step = max(1, CELLS // hist.shape[1])
    for a in range(0, len(hist), step):
        h = np.cumsum(hist[a:a + step].reshape(-1, allowed.shape[1], size), 2)
        n = np.rint(h / shift)
        s = h - n * shift
        n_all, s_all = n[:, :1, -1:], s[:, :1, -1:]
        right = n_all - n
        ok = (n >= min_leaf) & (right >= min_leaf) & allowed[a:a + len(h), :, None]
        score = np.where(ok, s * s / np.maximum(n, 1) + (s_all - s) ** 2 / np.maximum(right, 1), -1.0).reshape(len(h), -1)
        best = score.argmax(1)
        out.append((score[np.arange(len(h)), best], best // size, best % size, (s_all ** 2 / n_all).ravel(), n_all.ravel()))
    return [np.concatenate(c) for c in zip(*out)]


def _round(bins, target, sampled, chain: Chain, tree: np.ndarray, size: int, keep: list | None):
    """One tree per row of ``target`` (trees x rows), grown on the sampled rows: its value for every row.
    ``keep`` takes (tree, path, feature, cut, value) arrays of all nodes."""
    t, n = target.shape
    target, out = target.ravel(), np.zeros(t * n)
    top = np.abs(target).max(initial=0.0)
    bits = n.bit_length()
    shift, unit = 2.0 ** (52 - bits), (2.0 ** (49 - 2 * bits) / top if top > 0 else 1.0)
    cell = shift + np.rint(target * unit)
    live, slot = np.arange(t * n), np.repeat(np.arange(t), n)
    tree, path, hist, parent = tree, np.ones(t, np.int64), None, None
    for level in range(chain.depth + 1):
        m = len(tree)
        inside = sampled[live]
        rows, at = live[inside], slot[inside]
        count = np.bincount(at, minlength=m)
        value = np.bincount(at, target[rows], m) / np.maximum(count, 1)
        spread = np.bincount(at, target[rows] ** 2, m) / np.maximum(count, 1) - value ** 2
        feature, cut = np.full(m, LEAF), np.zeros(m, np.int64)
        open_ = (count >= 2 * chain.min_leaf) & (spread >= chain.min_gain) & (spread > 1e-12) & (level < chain.depth)
        if open_.any():
            if level == 0:
                asked = open_
            else:               # of two children the smaller; the other is the difference
                smaller = (count[::2] > count[1::2]).astype(np.int64)
                asked = np.zeros(m, bool)
                pairs = np.flatnonzero(open_[::2] | open_[1::2])
                asked[2 * pairs + smaller[pairs]] = True
            number = np.cumsum(asked) - 1
            own = asked[at]
            order = np.argsort(number[at[own]], kind="stable")
            told = _histograms(bins, (rows[own] % n)[order], number[at[own]][order], cell[rows[own]][order], int(asked.sum()), size)
            nodes = np.flatnonzero(open_)
            if level == 0:
                now = told
            else:
                first, small = told[number[2 * (nodes // 2) + smaller[nodes // 2]]], asked[nodes]
                now = np.where(small[:, None], first, hist[parent[nodes // 2]] - first)
            allowed = np.zeros((len(nodes), bins.shape[1]), bool)
            np.put_along_axis(allowed, drawn_features(chain.seed, tree[nodes], path[nodes], bins.shape[1], chain.features), True, 1)
            score, f, c, whole, total = _best(now, shift, allowed, size, chain.min_leaf)
            gain = (score - whole) / total / unit ** 2
            good = (score > whole * (1 + 1e-12)) & (gain > 0) & (gain >= chain.min_gain)
            feature[nodes[good]], cut[nodes[good]] = f[good], c[good]
            hist, parent = now, np.flatnonzero(good)
        if keep is not None:
            keep.append((tree, path, feature, cut, value))
        split = feature != LEAF
        done = ~split[slot]
        out[live[done]] = value[slot[done]]
        if not split.any():
            break
        live, up = live[~done], slot[~done]
        right = bins[live % n, feature[up]] > cut[up]
        slot = 2 * (np.cumsum(split) - 1)[up] + right
        s = np.flatnonzero(split)
        tree, path = np.repeat(tree[s], 2), np.ravel(np.stack([2 * path[s], 2 * path[s] + 1], 1))
    return out.reshape(t, n)


def grow_chains(bins: np.ndarray, y: np.ndarray, learn: np.ndarray, classes: Sequence[int], chain: Chain, size: int, nodes: bool):
    """(margins (class, row) of every row, nodes as (class, round, path, feature, cut, value) arrays if asked)."""
    classes, n = np.asarray(classes), len(bins)
    own = np.where(y[None, :] == classes[:, None], 1.0, -1.0)
    margin, kept = np.zeros(own.shape), []
    with np.errstate(over="ignore"):
        for r in range(chain.rounds):
            target = own if r == 0 else 4 * own / (1 + np.exp(2 * own * margin))
            sampled = np.broadcast_to(learn, own.shape)
            if chain.subsample < 1:
                sampled = learn & np.stack([np.random.default_rng([chain.seed, r, c]).random(n) < chain.subsample for c in classes.tolist()])
            keep = [] if nodes else None
            margin += (1.0 if r == 0 else chain.rate) * _round(bins, target, sampled.ravel(), chain, (r << 20) + classes, size, keep)
            kept += keep or []
    if not nodes:
        return margin, None
    tree, *rest = (np.concatenate(c) for c in zip(*kept))
    return margin, (tree & ((1 << 20) - 1), tree >> 20, *rest)


class Search:
    """What ``CrossValidatorModel`` tells of a search: mean and deviation over the folds per parameter map."""

    def __init__(self, maps: list[dict], mean: list[float], deviation: list[float]):
        self.maps, self.avgMetrics, self.stdMetrics = maps, mean, deviation

    def getEstimatorParamMaps(self) -> list[dict]:
        return self.maps


class _Table:
    """The binned rows in the shared folder: key, label, fold and, per fold left out, the bins by the other rows' edges."""

    def __init__(self, train: DataFrame, label_col: str, features_col: str, fold_col: str | None, folds: int):
        fold = col(fold_col).cast("int") if fold_col else F.lit(-1)
        rows = train.select(F.monotonically_increasing_id().alias("key"), col(label_col).cast("int").alias("y"), fold.alias("fold"),
                            as_array(train, features_col).alias("x")).where("fold IS NOT NULL")
        raw = work_dir(train.sparkSession, "chainrows")
        rows.write.parquet(raw)
        rows = train.sparkSession.read.schema(rows.schema).parquet(raw)
        told = rows.agg(F.count(F.lit(1)).alias("n"), F.count("y").alias("labelled"), F.count("x").alias("filled"),
                        F.max("y").alias("top"), F.max(F.size("x")).alias("f")).first()
        if not told.n:
            raise ValueError("no rows to fit")
        if told.labelled < told.n or told.filled < told.n:
            raise ValueError("labels and features must not be null")
        self.n, self.k, self.f, self.rows = told.n, told.top + 1, told.f, rows
        left_out = list(range(folds)) if fold_col else [-1]
        with ThreadPoolExecutor(len(left_out)) as pool:
            self.edges = list(pool.map(lambda i: bin_edges(rows.where(F.col("fold") != i) if fold_col else rows, self.f, BINS), left_out))
        self.left_out = left_out

    def grown(self, chains: list[Chain], nodes: bool):
        """One task per slot (chain, fold left out, classes): ``schema`` rows of margins, or of packed nodes."""
        edges, left_out, f, k = self.edges, self.left_out, self.f, self.k
        slots = []
        for c, chain in sorted(enumerate(chains), key=lambda x: -x[1].rounds * x[1].depth):     # the longest first
            g = 1 if chain.depth > 8 else max(1, min(-(-k // 2), GROUP_ROWS // self.n))
            slots += [(c, i, list(range(a, min(k, a + g)))) for i in range(len(left_out)) for a in range(0, k, g)]
        kind = np.dtype([("key", "<i8"), ("y", "<i4"), ("fold", "<i4"), ("b", "u1", (f,))])

        def deal(batches):
            for b in batches:
                for a in range(0, b.num_rows, DEAL_ROWS):
                    part = b.slice(a, DEAL_ROWS)
                    x, own = _matrix(part.column("x")), np.empty(part.num_rows, kind)
                    own["key"], own["y"], own["fold"] = (part.column(c).to_numpy() for c in ("key", "y", "fold"))
                    blobs = []
                    for e in edges:
                        own["b"] = binned(x, e)
                        blobs.append(own.tobytes())
                    for z in range(0, len(slots), DEAL_SLOTS):
                        to = range(z, min(len(slots), z + DEAL_SLOTS))
                        yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array([blobs[slots[s][1]] for s in to], pa.binary())],
                                                         ["slot", "v"])

        def grow(batches):
            slot, values = None, []
            for b in batches:
                for s, v in zip(b.column("slot").to_pylist(), b.column("v").to_pylist()):
                    slot = s
                    values.append(v)
            if slot is None:
                return
            c, i, classes = slots[slot]
            own = np.frombuffer(b"".join(values), kind)
            del values
            own = own[np.argsort(own["key"])]
            learn = own["fold"] != left_out[i] if left_out != [-1] else np.ones(len(own), bool)
            margin, made = grow_chains(np.ascontiguousarray(own["b"]), own["y"], learn, classes, chains[c], BINS, nodes)
            if nodes:
                cls, r, path, feature, cut, value = made
                for one in classes:
                    at = cls == one
                    blob = [a[at].astype(d).tobytes() for a, d in zip((r, path, feature, cut, value), _NODE)]
                    yield pa.RecordBatch.from_arrays([pa.array([one], pa.int32()), *[pa.array([v], pa.binary()) for v in blob]],
                                                     ["cls", "round", "path", "feature", "cut", "value"])
                return
            at = np.flatnonzero(~learn)
            for one, m in zip(classes, margin):
                same = lambda v: pa.array(np.full(len(at), v, np.int32))
                yield pa.RecordBatch.from_arrays([same(c), same(i), same(one), pa.array(own["key"][at]), pa.array(own["y"][at]), pa.array(m[at])],
                                                 ["trial", "fold", "cls", "key", "y", "margin"])

        schema = ("cls int, round binary, path binary, feature binary, cut binary, value binary" if nodes
                  else "trial int, fold int, cls int, key long, y int, margin double")
        return (self.rows.mapInArrow(deal, "slot int, v binary").repartitionById(len(slots), F.col("slot")).mapInArrow(grow, schema))


_NODE = ("<i4", "<i8", "<i2", "<u1", "<f8")


class Chains:
    """A packed model, for scoring."""

    def __init__(self, text: str):
        with np.load(io.BytesIO(base64.b64decode(text))) as m:
            self.k, self.rate = int(m["k"]), float(m["rate"])
            self.edges = np.split(m["edges"], np.cumsum(m["n_edges"])[:-1])
            at = np.cumsum(m["size"])[:-1]
            self.trees = list(zip(m["cls"].tolist(), m["round"].tolist(), *(np.split(m[c], at) for c in ("feature", "cut", "left", "value"))))

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Per row and class the sum of its trees."""
        bins, out = binned(x, self.edges), np.zeros((len(x), self.k))
        for c, r, feature, cut, left, value in self.trees:
            out[:, c] += (1.0 if r == 0 else self.rate) * value[_leaves(feature, cut, left, bins)]
        return out


class BoostedChainsModel(_Stage, HasFeaturesCol, HasRawPredictionCol, HasPredictionCol):
    """A margin per class and the class with the largest. Savable."""

    model = _param("model", "edges and trees, packed", TypeConverters.toString)

    def _transform(self, df: DataFrame) -> DataFrame:
        text, own = self.getOrDefault(self.model), []

        @F.arrow_udf("array<double>")
        def raw(x: pa.Array) -> pa.Array:
            if not own:
                own.append(Chains(text))
            got = own[0].raw(_matrix(x)) if len(x) else np.zeros((0, 1))
            return pa.ListArray.from_arrays(pa.array(np.arange(len(got) + 1) * got.shape[1], pa.int32()), pa.array(got.ravel()))

        df = df.withColumn("_margins", raw(as_array(df, self.getFeaturesCol())))
        index, _ = argmax_first("_margins")
        return df.withColumns({self.getRawPredictionCol(): array_to_vector("_margins"),
                               self.getPredictionCol(): index.cast("double")}).drop("_margins")


def _packed(rows: list, edges: list[np.ndarray], k: int, rate: float) -> str:
    parts = {c: [] for c in ("cls", "round", "size", "feature", "cut", "left", "value")}
    for row in sorted(rows, key=lambda r: r.cls):
        r, path, feature, cut, value = (np.frombuffer(row[c], d) for c, d in zip(("round", "path", "feature", "cut", "value"), _NODE))
        order = np.lexsort((path, r))
        r, path, feature, cut, value = (a[order] for a in (r, path, feature, cut, value))
        rounds, first = np.unique(r, return_index=True)
        for one, a, z in zip(rounds, first, [*first[1:], len(r)]):
            own, leaf = path[a:z], feature[a:z] == LEAF
            parts["cls"].append(row.cls), parts["round"].append(one), parts["size"].append(z - a)
            parts["feature"].append(feature[a:z]), parts["cut"].append(cut[a:z]), parts["value"].append(value[a:z])
            parts["left"].append(np.where(leaf, 0, np.searchsorted(own, 2 * own)).astype(np.int32))
    file = io.BytesIO()
    np.savez_compressed(file, k=np.array(k), rate=np.array(rate), edges=np.concatenate(edges), n_edges=np.array([len(e) for e in edges]),
                        **{c: np.array(v) if c in ("cls", "round", "size") else np.concatenate(v) for c, v in parts.items()})
    return base64.b64encode(file.getvalue()).decode()


class BoostedChains(Estimator, HasFeaturesCol, HasLabelCol, HasRawPredictionCol, HasPredictionCol, HasSeed):
    """One-vs-rest boosting with the parameters of ``GBTClassifier``."""

    maxIter = _param("maxIter", "trees of a class", TypeConverters.toInt)
    stepSize = _param("stepSize", "what a tree after the first counts", TypeConverters.toFloat)
    maxDepth = _param("maxDepth", "levels below the root", TypeConverters.toInt)
    minInstancesPerNode = _param("minInstancesPerNode", "fewest rows of a leaf", TypeConverters.toInt)
    subsamplingRate = _param("subsamplingRate", "share of the rows a tree is grown on", TypeConverters.toFloat)
    featureSubsetStrategy = _param("featureSubsetStrategy", "features drawn per node", TypeConverters.toString)
    minInfoGain = _param("minInfoGain", "least gain of a split", TypeConverters.toFloat)

    def __init__(self, **values):
        super().__init__()
        self._setDefault(maxIter=100, stepSize=0.1, maxDepth=3, minInstancesPerNode=1, subsamplingRate=1.0,
                         featureSubsetStrategy="all", minInfoGain=0.0, seed=42)
        self._set(**values)

    def library(self) -> OneVsRest:
        """The same by Spark's library, each level a distributed job."""
        names = ("maxIter", "stepSize", "maxDepth", "minInstancesPerNode", "subsamplingRate", "featureSubsetStrategy", "minInfoGain", "seed")
        gbt = GBTClassifier(**{n: self.getOrDefault(n) for n in names})
        return OneVsRest(classifier=gbt, labelCol=self.getLabelCol(), featuresCol=self.getFeaturesCol(),
                         rawPredictionCol=self.getRawPredictionCol(), predictionCol=self.getPredictionCol(), parallelism=8)

    def chain(self, n_features: int) -> Chain:
        get = self.getOrDefault
        strategy = get(self.featureSubsetStrategy)
        return Chain(get(self.maxIter), get(self.stepSize), get(self.maxDepth), get(self.minInstancesPerNode), get(self.subsamplingRate),
                     n_features if strategy == "auto" else _drawn(strategy, n_features), get(self.minInfoGain), self.getSeed())

    def cross_validate(self, maps: list[dict], train: DataFrame, fold_col: str, folds: int) -> Search:
        """Weighted F1 per map and fold, all chains of the search at once."""
        table = _Table(train, self.getLabelCol(), self.getFeaturesCol(), fold_col, folds)
        chains = [self.copy(m).chain(table.f) for m in maps]
        best = F.max(F.struct("margin", (-F.col("cls")).alias("c")))            # of equal margins the lower class
        scored = (table.grown(chains, False).groupBy("trial", "fold", "key").agg(best.alias("best"), F.first("y").alias("y"))
                       .select((F.col("trial") * folds + F.col("fold")).alias("model"), "y", (-F.col("best.c")).alias("p")))
        scores = {r.model: r.f1_score for r in per_model_scores(scored, "model", "y", "p").collect()}
        if len(scores) < len(maps) * folds:
            raise ValueError("a fold has no rows")
        scores = np.array([[scores[t * folds + i] for i in range(folds)] for t in range(len(maps))])
        return Search(maps, scores.mean(1).tolist(), scores.std(1).tolist())

    def _fit(self, train: DataFrame):
        if train.count() > CHAIN_ROWS:
            return self.library().fit(train)
        table = _Table(train, self.getLabelCol(), self.getFeaturesCol(), None, 0)
        rows = table.grown([self.chain(table.f)], True).collect()
        return BoostedChainsModel()._with(model=_packed(rows, table.edges[0], table.k, self.getOrDefault(self.stepSize)),
                                          featuresCol=self.getFeaturesCol(), rawPredictionCol=self.getRawPredictionCol(),
                                          predictionCol=self.getPredictionCol())
