import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from sievekit.operators import splitting
from sievekit.plans import boosted_chains, ml_catalog, training
from sievekit.session import work_dir
from sievekit.sources.artifacts import load_model, save_model
from tests.conftest import SF0001


def table(spark, n=600, seed=3, values=9):
    """Three classes that follow from two of four features with few values, a tenth of the labels at random."""
    rng = np.random.default_rng(seed)
    x = rng.integers(0, values, (n, 4)).astype(float)
    y = np.where(x[:, 0] > 5, 2, (x[:, 1] > 3).astype(int))
    y = np.where(rng.random(n) < 0.1, rng.integers(0, 3, n), y)
    rows = [(i, float(c), v) for i, (c, v) in enumerate(zip(y.tolist(), x.tolist()))]
    return spark.createDataFrame(rows, "id long, label_idx double, x array<double>").withColumn("features", array_to_vector("x"))


def margins(model, df):
    rows = model.transform(df).select("id", "prediction", vector_to_array("rawPrediction").alias("m")).orderBy("id").collect()
    return np.array([r.m for r in rows]), [r.prediction for r in rows]


def test_chains_are_the_librarys_trees(spark):
    """Same splits, leaf values and weights where nothing is drawn; of equally good splits either may be taken."""
    df = table(spark, 1000)
    for kw in ({"maxIter": 3, "maxDepth": 3, "minInstancesPerNode": 20}, {"maxIter": 4, "maxDepth": 4, "minInfoGain": 0.02, "stepSize": 0.3}):
        est = training.boosted_chains_estimator(**kw)
        got, label = margins(est.fit(df), df)
        want, library = margins(est.library().fit(df), df)
        near = np.abs(got - want) < 1e-6
        assert near.mean() > 0.98 and near.all(0).sum() >= 2
        assert np.mean(np.array(label) == np.array(library)) > 0.99


def test_search_is_the_librarys(spark):
    df = splitting.stratified_kfold(table(spark), "label_idx", "id", 3).cache()
    est = training.boosted_chains_estimator()
    maps = [{est.maxIter: 5, est.maxDepth: 2}, {est.maxIter: 3, est.maxDepth: 4, est.minInstancesPerNode: 5}]
    found = training.cross_validate(est, maps, df, num_folds=3)
    library = est.library()
    own = [{getattr(library.getClassifier(), p.name): v for p, v in m.items()} for m in maps]
    want = training.cross_validate(library, own, df, num_folds=3)
    assert np.allclose(found.avgMetrics, want.avgMetrics) and np.allclose(found.stdMetrics, want.stdMetrics)
    model, params, score = training.refit_best(found, est, df)
    assert score == max(found.avgMetrics) and params["maxIter"] in (3, 5)
    assert training.tuning_report(found, params, 0.5)["n_trials"] == "2"


def test_classes_may_share_a_task(spark, monkeypatch):
    df = table(spark).coalesce(1)
    est = training.boosted_chains_estimator(maxIter=5, maxDepth=4, subsamplingRate=0.7, featureSubsetStrategy="0.6")
    want, _ = margins(est.fit(df), df)
    monkeypatch.setattr(boosted_chains, "GROUP_ROWS", 1)
    monkeypatch.setattr(boosted_chains, "CELLS", 500)           # histograms in pieces
    monkeypatch.setattr(boosted_chains, "DEAL_ROWS", 50)
    assert np.array_equal(margins(est.fit(df), df)[0], want)


def test_a_larger_table_is_the_librarys(spark, monkeypatch):
    df = splitting.stratified_kfold(table(spark, 200), "label_idx", "id", 2).cache()
    est = training.boosted_chains_estimator(maxIter=2, maxDepth=2)
    want = training.cross_validate(est, [{est.maxDepth: 2}], df, num_folds=2)
    monkeypatch.setattr(boosted_chains, "CHAIN_ROWS", 100)
    assert np.allclose(training.cross_validate(est, [{est.maxDepth: 2}], df, num_folds=2).avgMetrics, want.avgMetrics)
    assert not isinstance(est.fit(df), boosted_chains.BoostedChainsModel)


def test_saved_and_null_labels(spark):
    df = table(spark, 200)
    model = training.boosted_chains_estimator(maxIter=3).fit(df)
    loaded = load_model(save_model(PipelineModel([model]), work_dir(spark, "chains")))
    assert np.array_equal(margins(loaded, df)[0], margins(model, df)[0])
    with pytest.raises(ValueError):
        training.boosted_chains_estimator(maxIter=3).fit(df.withColumn("label_idx", F.when(F.col("id") > 3, F.col("label_idx"))))


def test_search_of_the_whole_space_ends(spark):
    """All rounds of both trials, folds and classes: 130,000 trees."""
    rows = ml_catalog.q_m9(spark, SF0001).collect()
    assert [r.trial for r in rows] == [0, 1] and all(0 <= r.cv_mean <= 1 and r.cv_two_std >= 0 for r in rows)
