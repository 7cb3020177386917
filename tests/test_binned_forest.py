import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from sievekit.plans import binned_forest, training
from sievekit.session import work_dir
from sievekit.sources.artifacts import load_model, save_model


def table(spark, n=1200, seed=3):
    """Three classes that follow from the first two of four features, a tenth of the labels at random."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4))
    y = np.where(x[:, 0] > 0.3, 2, (x[:, 1] > 0).astype(int))
    y = np.where(rng.random(n) < 0.1, rng.integers(0, 3, n), y)
    rows = [(i, float(c), v) for i, (c, v) in enumerate(zip(y.tolist(), x.tolist()))]
    return spark.createDataFrame(rows, "id long, label_idx double, x array<double>").withColumn("features", array_to_vector("x"))


def probabilities(model, df):
    return {r.id: tuple(r.p) for r in model.transform(df).select("id", vector_to_array("probability").alias("p")).collect()}


def test_large_and_small_nodes_give_the_same_trees(spark, monkeypatch):
    """Wherever the distributed levels end, and however the rows lie."""
    df = table(spark)
    for est in (training.extra_trees(6, None, 7), training.counted_forest(6, 8, 7)):
        want = probabilities(est.fit(df), df)
        assert all(abs(sum(p) - 1) < 1e-9 for p in want.values())
        monkeypatch.setattr(binned_forest, "LOCAL_ROWS", 40)
        monkeypatch.setattr(binned_forest, "PASS_BYTES", 1 << 16)       # several passes a level
        assert probabilities(est.fit(df.repartition(5)), df) == want
        monkeypatch.undo()


def test_fits_as_well_as_the_library(spark):
    train, test = table(spark), table(spark, 600, 4)

    def accuracy(est):
        return est.fit(train).transform(test).agg(F.avg((F.col("prediction") == F.col("label_idx")).cast("double"))).first()[0]

    library = accuracy(training.forest(20, 8, 42))
    for est in (training.counted_forest(20, 8, 42), training.extra_trees(20, None, 42, min_instances=3)):
        assert accuracy(est) > library - 0.04 > 0.75


def test_unlimited_trees_hold_every_training_row(spark):
    df = table(spark, 200)
    rows = training.extra_trees(3, None, 1, maxBins=256).fit(df).transform(df).collect()
    assert all(r.prediction == r.label_idx and r.probability[int(r.label_idx)] == 1.0 for r in rows)


def test_saved_and_copied(spark):
    df = table(spark, 200)
    est = training.extra_trees(3, None, 1)
    model = est.copy({est.numTrees: 5, est.maxDepth: 2}).fit(df)
    assert model.getOrDefault("trees") == 5
    loaded = load_model(save_model(PipelineModel([model]), work_dir(spark, "forest")))
    assert probabilities(loaded, df) == probabilities(model, df)


def test_baseline_counts_equal_rows(spark):
    """As many binned rows as there are cells, however many rows; draws of a cell add up."""
    df = table(spark, 200)
    df = df.select("id", "label_idx", F.array_repeat(F.pmod("id", F.lit(3)).cast("double"), 2).alias("x"))
    growth = binned_forest._Growth(df.withColumn("features", array_to_vector("x")), "label_idx", "features", 400, 5, 1, "auto", True, 32, 42)
    assert growth.rows.count() <= 9
    drawn = [np.frombuffer(r.w, np.int32).sum() for r in growth.rows.collect()]
    assert abs(sum(drawn) / 400 - 200) < 4
    few = growth.edges[0].tolist()
    assert few == [0.0, 1.0]


def test_a_large_model_stays_in_parts(spark, monkeypatch):
    """The driver holds the upper levels only; probabilities, saving and loading as of a model in one piece."""
    df = table(spark)
    for est in (training.extra_trees(6, None, 7), training.counted_forest(6, 8, 7)):
        monkeypatch.setattr(binned_forest, "LOCAL_ROWS", 100)
        whole = est.fit(df)
        want = probabilities(whole, df)
        monkeypatch.setattr(binned_forest, "MODEL_NODES", 500)     # a tree has some 600 nodes: borders lie within trees
        monkeypatch.setattr(binned_forest, "SCORE_ROWS", 70)
        model = est.fit(df)
        assert model.getOrDefault("parts") > 3 and len(model.getOrDefault("model")) < len(whole.getOrDefault("model"))
        loaded = load_model(save_model(PipelineModel([model]), work_dir(spark, "forest")))
        for one in (model, loaded):
            got = probabilities(one, df)
            assert got.keys() == want.keys() and all(np.allclose(got[i], want[i], atol=1e-9) for i in want)
        assert loaded.stages[0].getOrDefault("table") != model.getOrDefault("table")
        scored = model.transform(df.where("id < 0"))
        assert scored.count() == 0 and scored.columns == whole.transform(df).columns
        monkeypatch.undo()


def test_shallow_forests_of_many_rows_are_one_object(spark, monkeypatch):
    """Parts follow the nodes there can be, not the rows."""
    monkeypatch.setattr(binned_forest, "MODEL_NODES", 100)
    assert training.counted_forest(2, 3, 7).fit(table(spark)).getOrDefault("parts") == 0


def test_poisson_weights():
    w = binned_forest.poisson_weights(np.arange(2000, dtype=np.uint64), np.ones(2000, np.int64), 50, 42)
    assert abs(w.mean() - 1) < 0.02 and abs(w.var() - 1) < 0.03
