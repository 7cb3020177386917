"""Model training and search on pyspark.ml (M1-M7, M9, M10) plus label maps.

Each fit is a distributed job; candidate fits overlap through
``CrossValidator.parallelism``. Trees bin features by ``maxBins``.
"""

from __future__ import annotations

import json
import math
import random
import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LinearSVC, LogisticRegression, OneVsRest,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from sievekit.functions.names import col, quoted, text_literal
from sievekit.plans import boosted_chains
from sievekit.plans.binned_forest import BinnedForest
from sievekit.plans.stages import AssembleColumns, ClassProbabilities

MAX_DEPTH = 30        # Spark's tree depth limit; stands in for "unlimited"
FIT_PARTITIONS = 8    # of the input of a forest, at least, whatever the cluster
FIT_ROWS = 1_000_000  # of such a partition, at most (about)


# ---------------------------------------------------------------- F9
class LabelMap:
    """Sorted distinct labels <-> 0..K-1 (numeric order for numbers; no StringIndexer,
    which would sort 10 before 3). Encoding joins the (label, index) table, so
    its cost per row does not grow with K; decoding indexes an array."""

    def __init__(self, labels: Sequence, label_col: str, index_col: str, label_type=None):
        self.labels = list(labels)
        self.label_col, self.index_col, self.label_type = label_col, index_col, label_type

    def table(self, df: DataFrame) -> DataFrame:
        kind = self.label_type or df.schema[self.label_col].dataType
        schema = StructType([StructField("_label", kind), StructField(self.index_col, IntegerType())])
        return df.sparkSession.createDataFrame(list(zip(self.labels, range(len(self.labels)))), schema)

    def encode(self, df: DataFrame) -> DataFrame:
        """Unknown and null labels get a null index."""
        return df.join(self.table(df), col(self.label_col) == F.col("_label"), "left").drop("_label")

    def decode(self, df: DataFrame, index_col: str | None = None, out: str | None = None) -> DataFrame:
        values = F.array(*[F.lit(v) for v in self.labels])      # folded to one constant
        return df.withColumn(out or self.label_col, F.get(values, col(index_col or self.index_col).cast("int")))

    def encoder_stage(self) -> SQLTransformer:
        """Persistable pipeline stage (S8) doing the same mapping."""
        cases = " ".join(f"WHEN {_sql_lit(v)} THEN {i}" for i, v in enumerate(self.labels))
        return SQLTransformer(statement=f"SELECT *, CAST(CASE {quoted(self.label_col)} {cases} END AS DOUBLE)"
                                        f" AS {quoted(self.index_col)} FROM __THIS__")

    def decoder_stage(self, pred_col: str = "prediction", out: str = "predicted_label") -> SQLTransformer:
        values = ", ".join(_sql_lit(v) for v in self.labels)
        return SQLTransformer(statement=f"SELECT *, get(array({values}), CAST({quoted(pred_col)} AS INT))"
                                        f" AS {quoted(out)} FROM __THIS__")


def _sql_lit(v) -> str:
    return text_literal(v) if isinstance(v, str) else repr(v)


def fit_label_map(df: DataFrame, label: str, index_col: str = "label_idx") -> LabelMap:
    """the distinct labels, as many as a model has outputs."""
    rows = df.where(col(label).isNotNull()).select(col(label)).distinct().collect()
    return LabelMap(sorted(r[0] for r in rows), label, index_col, df.schema[label].dataType)


def spread(df: DataFrame, id_col: str, partitions: int | None = None) -> DataFrame:
    """Training input of a tree ensemble: dealt by id into partitions whose number
    follows from the counted rows, and sorted by id there. Bagging is seeded per
    partition, so the fitted model depends on the data and the seed, not on how
    the input lay or how many cores there are."""
    if partitions is None:
        partitions = max(FIT_PARTITIONS, math.ceil(df.count() / FIT_ROWS))
    return df.repartition(partitions, col(id_col)).sortWithinPartitions(col(id_col))


# ---------------------------------------------------------------- estimators
def _depth(max_depth: int | None) -> int:
    if max_depth is None:
        return MAX_DEPTH
    if max_depth > MAX_DEPTH:
        raise ValueError(f"max_depth {max_depth} exceeds Spark's limit of {MAX_DEPTH}")
    return max_depth


def forest(num_trees: int = 100, max_depth: int | None = 10, seed: int = 42,
           label_col: str = "label_idx", features_col: str = "features", min_instances: int = 1,
           **kw) -> RandomForestClassifier:
    """M1: random forest (reference: 100 trees, depth 10, seed 42)."""
    return RandomForestClassifier(numTrees=num_trees, maxDepth=_depth(max_depth), seed=seed, labelCol=label_col,
                                  featuresCol=features_col, minInstancesPerNode=min_instances, **kw)


def counted_forest(num_trees: int = 100, max_depth: int | None = 10, seed: int = 42,
                   label_col: str = "label_idx", features_col: str = "features", min_instances: int = 1,
                   **kw) -> BinnedForest:
    """M1 on counted rows: as :func:`forest`, but rows with equal bins are one,
    so that few features cost the same at any number of rows."""
    return BinnedForest(numTrees=num_trees, maxDepth=_depth(max_depth), bootstrap=True, seed=seed, labelCol=label_col,
                        featuresCol=features_col, minInstancesPerNode=min_instances, **kw)


def extra_trees(num_trees: int = 100, max_depth: int | None = None, seed: int = 42,
                label_col: str = "label_idx", features_col: str = "features", min_instances: int = 1,
                **kw) -> BinnedForest:
    """M6: trees on all rows: no bootstrap, sqrt features per node. Unlimited
    depth grows a leaf for every few rows; a large model stays in the shared folder."""
    return BinnedForest(numTrees=num_trees, maxDepth=_depth(max_depth), bootstrap=False,
                        featureSubsetStrategy="sqrt", seed=seed, labelCol=label_col,
                        featuresCol=features_col, minInstancesPerNode=min_instances, **kw)


def boosted(max_iter: int = 100, step_size: float = 0.1, max_depth: int = 3,
            subsampling_rate: float = 1.0, seed: int = 42, label_col: str = "label_idx",
            features_col: str = "features", **kw) -> OneVsRest:
    """M3: multiclass boosting as one-vs-rest over binary GBTs (bare GBT is binary only)."""
    gbt = GBTClassifier(maxIter=max_iter, stepSize=step_size, maxDepth=max_depth,
                        subsamplingRate=subsampling_rate, seed=seed, **kw)
    return OneVsRest(classifier=gbt, labelCol=label_col, featuresCol=features_col, parallelism=8)


def boosted_chains_estimator(label_col: str = "label_idx", features_col: str = "features", **kw) -> boosted_chains.BoostedChains:
    """As :func:`boosted`, the trees of each class, fold and trial grown in a task of their own."""
    return boosted_chains.BoostedChains(labelCol=label_col, featuresCol=features_col, **kw)


def margin(max_iter: int = 100, reg_param: float = 0.0, label_col: str = "label_idx",
           features_col: str = "features") -> OneVsRest:
    """M7: linear SVM one-vs-rest (run on robust-scaled features). No probabilities;
    ``fit_margin_prob`` has them."""
    return OneVsRest(classifier=LinearSVC(maxIter=max_iter, regParam=reg_param),
                     labelCol=label_col, featuresCol=features_col, parallelism=8)


def _fit_per_class(train: DataFrame, n_classes: int, label_col: str, parallelism: int, out: str,
                   fit_one: Callable[[DataFrame, int], tuple[list, str, list[str]]]) -> PipelineModel:
    """One binary model per class, fitted concurrently as ``OneVsRest`` does.
    ``fit_one`` gives its stages, its probability column and its scratch
    columns; the pipeline normalises the class-1 probabilities into ``out``."""
    def fit(k: int):
        return fit_one(train.withColumn("_bin", (col(label_col) == k).cast("double")), k)

    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, n_classes))) as pool:
        fitted = list(pool.map(fit, range(n_classes)))
    stages = [s for own, _, _ in fitted for s in own]
    scratch = [c for _, _, own in fitted for c in own]
    return PipelineModel([*stages, ClassProbabilities.of([p for _, p, _ in fitted], out, scratch)])


def fit_boosted_prob(train: DataFrame, n_classes: int, label_col: str = "label_idx",
                     features_col: str = "features", validation_col: str | None = None,
                     validation_tol: float = 0.01, parallelism: int = 8, out: str = "probability_arr",
                     **gbt_kw) -> PipelineModel:
    """M3-M5: a binary GBT per class with optional early stopping
    (``validationIndicatorCol`` + ``validationTol``) and normalised class
    probabilities, so boosted models can take part in a soft vote. Savable."""
    def fit_one(data: DataFrame, k: int):
        kw = dict(gbt_kw)
        if validation_col:
            kw.update(validationIndicatorCol=validation_col, validationTol=validation_tol)
        m = GBTClassifier(labelCol="_bin", featuresCol=features_col, **kw).fit(data)
        names = [f"_{x}_{out}_{k}" for x in ("pred", "raw", "prob")]
        m.setPredictionCol(names[0]).setRawPredictionCol(names[1]).setProbabilityCol(names[2])
        return [m], names[2], names

    return _fit_per_class(train, n_classes, label_col, parallelism, out, fit_one)


def fit_margin_prob(train: DataFrame, n_classes: int, label_col: str = "label_idx",
                    features_col: str = "features", max_iter: int = 100, reg_param: float = 0.0,
                    parallelism: int = 8, out: str = "probability_arr") -> PipelineModel:
    """M7 with probabilities: a linear SVM per class, its margin calibrated by a
    logistic regression, normalised over the classes. Savable."""
    def fit_one(data: DataFrame, k: int):
        names = [f"_{x}_{out}_{k}" for x in ("spred", "sraw", "pred", "raw", "prob")]
        svm = LinearSVC(labelCol="_bin", featuresCol=features_col, maxIter=max_iter, regParam=reg_param,
                        predictionCol=names[0], rawPredictionCol=names[1]).fit(data)
        scale = LogisticRegression(labelCol="_bin", featuresCol=names[1], maxIter=50, regParam=1e-6,
                                   predictionCol=names[2], rawPredictionCol=names[3],
                                   probabilityCol=names[4]).fit(svm.transform(data))
        return [svm, scale], names[4], names

    return _fit_per_class(train, n_classes, label_col, parallelism, out, fit_one)


# ---------------------------------------------------------------- grids and search
# The parameter grids to be searched, by model.
FOREST_GRID = {"trees": [200, 300, 500], "depth": [15, 20, 25, None], "split": [2, 5, 10], "leaf": [1, 2, 4],
               "features": ["sqrt", "log2"]}
FOREST_GRID_LARGE = {"trees": [300, 500, 1000], "depth": [15, 20, 25, None], "split": [2, 5, 10],
                     "leaf": [1, 2, 4], "features": ["sqrt", "log2"], "bootstrap": [True, False]}
EXTRA_TREES_GRID = {"trees": [200, 300, 500], "depth": [15, 20, 25, None], "split": [2, 5], "leaf": [1, 2]}
EXTRA_TREES_GRID_LARGE = {"trees": [300, 500, 1000], "depth": [15, 20, 25, None], "split": [2, 5], "leaf": [1, 2]}
BOOSTED_GRID = {"rounds": [200, 300], "rate": [0.05, 0.1, 0.15], "depth": [6, 8, 10], "subsample": [0.8, 0.9, 1.0]}
BOOSTED_GRID_LARGE = {"rounds": [200, 300, 500], "rate": [0.05, 0.1, 0.15], "depth": [6, 8, 10],
                      "subsample": [0.8, 0.9, 1.0]}
SOFTPROB_GRID = {"rounds": [500, 1000], "depth": [6, 8, 10], "rate": [0.05, 0.1], "subsample": [0.8, 0.9],
                 "columns": [0.8, 0.9]}
MARGIN_GRID = {"C": [1, 10, 100]}
# Bounds of the booster search; (low, high) or (low, high, step).
BOOSTER_SPACE = {"rate": (0.02, 0.2), "depth": (4, 12), "min_child": (1.0, 10.0), "subsample": (0.6, 1.0),
                 "columns": (0.6, 1.0), "min_gain": (0.0, 5.0), "rounds": (400, 1400, 200)}


def param_grid(est: Estimator, values: dict) -> list[dict]:
    """M2-M7 grids as parameter maps. ``split`` (fewest rows of a node that may
    split) has no counterpart in Spark's trees and is left out, so a grid of 216
    combinations has 72 maps; the kernels of the margin model are linear only."""
    inner = est.getClassifier() if isinstance(est, OneVsRest) else est
    grid = ParamGridBuilder()
    params = {"trees": "numTrees", "leaf": "minInstancesPerNode", "features": "featureSubsetStrategy",
              "bootstrap": "bootstrap", "rounds": "maxIter", "rate": "stepSize", "subsample": "subsamplingRate"}
    for name, choices in values.items():
        if name == "split":
            continue
        if name == "depth":
            grid.addGrid(inner.maxDepth, [_depth(c) for c in choices])
        elif name == "columns":
            grid.addGrid(inner.featureSubsetStrategy, [str(c) for c in choices])
        elif name == "C":                 # the penalty is the inverse of the regularisation
            grid.addGrid(inner.regParam, [1.0 / c for c in choices])
        else:
            grid.addGrid(getattr(inner, params[name]), choices)
    return grid.build()


def cross_validate(est: Estimator, grid, train: DataFrame, label_col: str = "label_idx",
                   fold_col: str = "fold", num_folds: int = 5, parallelism: int = 4, seed: int = 42):
    """M2/M9: CrossValidator on the stratified ``fold`` column (X2), weighted F1.
    A search of boosted chains is one job over all of them."""
    if isinstance(est, boosted_chains.BoostedChains):
        if train.count() <= boosted_chains.CHAIN_ROWS:
            return est.cross_validate(grid, train, fold_col, num_folds)
        library = est.library()
        maps = [{getattr(library.getClassifier(), p.name): v for p, v in m.items()} for m in grid]
        cv = cross_validate(library, maps, train, label_col, fold_col, num_folds, parallelism, seed)
        return boosted_chains.Search(grid, cv.avgMetrics, cv.stdMetrics)
    ev = MulticlassClassificationEvaluator(labelCol=label_col, metricName="f1")
    cv = CrossValidator(estimator=est, estimatorParamMaps=grid, evaluator=ev, numFolds=num_folds,
                        foldCol=fold_col, parallelism=parallelism, seed=seed)
    return cv.fit(train)


def random_search_space(est: OneVsRest | boosted_chains.BoostedChains, n: int, seed: int = 42, space: dict = BOOSTER_SPACE) -> list[dict]:
    """M9: ``n`` seeded random parameter maps of the booster (the adaptive
    sampler is not built): step size log-uniform, the rest uniform between the
    bounds, ``depth`` and ``rounds`` whole numbers. The L1 and L2 penalties of
    the space have no counterpart in Spark's trees."""
    rng = random.Random(seed)
    g = est.getClassifier() if isinstance(est, OneVsRest) else est
    low, high = space["rate"]
    maps = []
    for _ in range(n):
        first, last, step = space["rounds"]
        maps.append({g.stepSize: math.exp(rng.uniform(math.log(low), math.log(high))),
                     g.maxDepth: rng.randint(*space["depth"]),
                     g.minInstancesPerNode: round(rng.uniform(*space["min_child"])),
                     g.subsamplingRate: rng.uniform(*space["subsample"]),
                     g.featureSubsetStrategy: str(round(rng.uniform(*space["columns"]), 3)),
                     g.minInfoGain: rng.uniform(*space["min_gain"]) / 100,
                     g.maxIter: rng.randrange(first, last + 1, step)})
    return maps


def refit_best(cv_model, est: Estimator, train: DataFrame) -> tuple:
    """Best parameter map of a CV run, refitted on the whole train split."""
    metrics = list(cv_model.avgMetrics)
    best_i = max(range(len(metrics)), key=lambda i: (metrics[i], -i))
    best_params = cv_model.getEstimatorParamMaps()[best_i]
    model = est.copy(best_params).fit(train)
    return model, {p.name: v for p, v in best_params.items()}, metrics[best_i]


def tuning_report(cv_model, best_params: dict, validation_f1: float) -> dict[str, str]:
    """What a search found: best parameters and value, hold-out F1, trials."""
    return {"best_params": json.dumps(best_params, sort_keys=True), "best_value": str(max(cv_model.avgMetrics)),
            "val_weighted_f1": str(validation_f1), "n_trials": str(len(cv_model.avgMetrics))}


# ---------------------------------------------------------------- pipeline
def model_pipeline(features: Sequence[str], label_map: LabelMap, estimator: Estimator,
                   features_col: str = "features") -> Pipeline:
    """Label encoder -> assembler -> estimator -> label decoder, persistable as one unit."""
    return Pipeline(stages=[
        label_map.encoder_stage(),
        AssembleColumns.of(list(features), features_col),
        estimator,
        label_map.decoder_stage(),
    ])


def timed_fit(fit: Callable[[DataFrame], object], df: DataFrame):
    """V9: the fitted model and the wall time of ``fit(df)``. Give it a table
    that is written or cached and filled, or the first model pays for the
    reading."""
    t0 = time.perf_counter()
    model = fit(df)
    return model, time.perf_counter() - t0


def timed_predict(model, df: DataFrame) -> float:
    """V9: wall time of scoring every row."""
    t0 = time.perf_counter()
    model.transform(df).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0
