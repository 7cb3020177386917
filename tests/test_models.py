"""Invariants for trained models (rows-only operators in the catalog)."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from sievekit.operators import voting
from sievekit.plans import ml_catalog, scoring, training
from tests.conftest import SF0001


@pytest.fixture(scope="module")
def data(spark):
    train, test, lm = ml_catalog.prepared(spark, SF0001)
    return train.cache(), test.cache(), lm


def test_forest_invariants(spark, data):
    train, test, lm = data
    m1 = training.forest(20, 6, 42).fit(train)
    m2 = training.forest(20, 6, 42).fit(train)
    s1 = m1.transform(test).select("vec_id", "prediction", vector_to_array("probability").alias("p"))
    rows = s1.collect()
    assert len(rows) == test.count()
    for r in rows:
        assert abs(sum(r.p) - 1.0) < 1e-9
        assert int(r.prediction) == max(range(len(r.p)), key=lambda i: (r.p[i], -i))
    s2 = {r.vec_id: r.prediction for r in m2.transform(test).select("vec_id", "prediction").collect()}
    assert {r.vec_id: r.prediction for r in rows} == s2          # fixed seed repeatable


def test_boosted_margin_and_vote_survive_saving(spark, data):
    """Per-class models, scaler, selection and vote as one pipeline."""
    from pyspark.ml import PipelineModel
    from sievekit.plans.stages import ClassProbabilities, RobustScale, SelectColumns, SoftVote
    from sievekit.session import work_dir
    from sievekit.sources.artifacts import load_model, save_model
    train, test, lm = data
    k = len(lm.labels)
    gb = training.fit_boosted_prob(train, k, maxIter=2, maxDepth=2, seed=42, out="p_gb")
    svm = training.fit_margin_prob(train, k, max_iter=5, out="p_svm")
    rf = training.forest(10, 5, 42).setProbabilityCol("p_rf").setRawPredictionCol("r_rf") \
        .setPredictionCol("y_rf").fit(train)
    model = PipelineModel([RobustScale.of({"label_idx": (4.0, 2.0)}, "_s"), gb, svm, rf,
                           SoftVote.of(["p_gb", "p_svm", "p_rf"]),
                           SelectColumns.of(["label_idx_s", "probs", "confidence", "pred_index", "p_gb", "p_svm"], ["vec_id"])])
    loaded = load_model(save_model(model, work_dir(spark, "stages")))
    a, b = ({r.vec_id: r for r in m.transform(test).collect()} for m in (model, loaded))
    assert a == b and len(a) == test.count()
    for r in a.values():
        assert all(abs(sum(p) - 1.0) < 1e-9 for p in (r.p_gb, r.p_svm, r.probs))
        assert r.probs[r.pred_index] == r.confidence == max(r.probs)
    zero = spark.createDataFrame([([1.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    assert ClassProbabilities.of(["a", "b"], "p", ["a", "b"]).transform(zero).first().p == [0.5, 0.5]


def test_forest_does_not_depend_on_how_the_input_lay(spark, data):
    train, test, _ = data
    got = []
    for n in (1, 8):
        model = training.forest(20, 6, 42).fit(training.spread(train.repartition(n), "vec_id"))
        got.append({r.vec_id: r.prediction for r in model.transform(test).select("vec_id", "prediction").collect()})
    assert got[0] == got[1]


def test_partitions_of_a_fit_follow_the_rows(spark, monkeypatch):
    rows = spark.range(1000).withColumnRenamed("id", "vec_id")
    assert training.spread(rows, "vec_id").rdd.getNumPartitions() == training.FIT_PARTITIONS
    monkeypatch.setattr(training, "FIT_ROWS", 60)
    dealt = training.spread(rows.repartition(3), "vec_id")
    again = training.spread(rows.repartition(40), "vec_id")
    assert dealt.rdd.getNumPartitions() == 17
    assert dealt.rdd.glom().collect() == again.rdd.glom().collect()


def test_depth_beyond_the_limit_is_an_error():
    with pytest.raises(ValueError):
        training.forest(10, 31)
    assert training.extra_trees(10, None).getMaxDepth() == 30


def test_grids_hold_the_values(spark):
    forest = training.forest()
    assert len(training.param_grid(forest, training.FOREST_GRID)) == 72
    assert len(training.param_grid(forest, training.FOREST_GRID_LARGE)) == 144
    assert len(training.param_grid(training.boosted(), training.BOOSTED_GRID)) == 54
    assert len(training.param_grid(training.boosted(), training.SOFTPROB_GRID)) == 48
    assert len(training.param_grid(training.margin(), training.MARGIN_GRID)) == 3
    est = training.boosted()
    g = est.getClassifier()
    for m in training.random_search_space(est, 50, seed=3):
        assert 0.02 <= m[g.stepSize] <= 0.2 and 4 <= m[g.maxDepth] <= 12 and m[g.maxIter] in range(400, 1401, 200)


def test_labels_are_joined(spark):
    df = spark.createDataFrame([(10,), (3,), (9,), (None,), (3,)], "y int")
    lm = training.fit_label_map(df, "y", "i")
    got = lm.decode(lm.encode(df), "i", "back").collect()
    assert {(r.y, r.i, r.back) for r in got} == {(3, 0, 3), (9, 1, 9), (10, 2, 10), (None, None, None)}
    text = training.fit_label_map(spark.createDataFrame([("it's",), ("b",)], "y string"), "y", "i")
    back = text.decoder_stage("i", "o").transform(text.encoder_stage().transform(
        spark.createDataFrame([("it's",), ("b",)], "y string"))).collect()
    assert {(r.y, r.o) for r in back} == {("it's", "it's"), ("b", "b")}


def test_text_labels_have_no_tier(spark, data):
    train, test, _ = data
    text = train.withColumn("label", F.concat(F.lit("c"), "label"))
    lm = training.fit_label_map(text, "label", "label_idx")
    model = training.forest(5, 3, 42).fit(train)
    out = scoring.score(test, model, lm, keep=("vec_id",)).collect()
    assert {r.tier for r in out} == {None} and all(r.prediction.startswith("c") for r in out)


def test_score_decodes_labels(spark, data):
    train, test, lm = data
    model = training.forest(10, 5, 42).fit(train)
    out = scoring.score(test, model, lm, keep=("vec_id", "label")).collect()
    assert len(out) == test.count()
    assert {r.prediction for r in out} <= set(lm.labels)
    assert all(r.confidence_pct == round(r.confidence * 100, 1) for r in out)


def test_cross_validation_on_fold_column(spark, data):
    from sievekit.operators import splitting
    train, _, _ = data
    tr = splitting.stratified_kfold(train, "label", "vec_id", 3)
    est = training.forest(5, 3, 42)
    maps = training.param_grid(est, {"trees": [3, 5]})
    cv = training.cross_validate(est, maps, tr, num_folds=3, parallelism=2)
    model, params, score = training.refit_best(cv, est, tr)
    assert len(cv.avgMetrics) == 2 and 0.0 <= score <= 1.0 and "numTrees" in params
    report = training.tuning_report(cv, params, 0.5)
    assert report["n_trials"] == "2" and "numTrees" in report["best_params"]


def test_experiment(spark):
    from sievekit.plans.experiment import run_experiment
    from sievekit.sources.artifacts import read_runs
    rows = [(i, (i * 7) % 11 + (i % 2) * 3.0, (i * 5) % 13 * 1.0, i % 2) for i in range(160)]
    rows += [(1000 + i, a, b, y) for i, a, b, y in rows[:40]]          # repeats under other ids
    df = spark.createDataFrame(rows, "id long, `a.x` double, b double, y int")
    out = run_experiment(spark, df, ["a.x", "b"], "y", "id", k_best=2, trees=5, boosted_rounds=2, svm_rounds=5,
                         engineer=lambda x: x.withColumn("b2", F.col("b") * F.col("b")))
    board = out.board.orderBy("rank").collect()
    assert [r["rank"] for r in board] == [1, 2, 3, 4, 5] and board[0].model == out.best
    assert all(r.train_seconds > 0 and r.predict_seconds > 0 for r in board)
    scored = out.scored.collect()
    distinct = len({(a, b, y) for _, a, b, y in rows})
    assert all(r.same for r in scored) and abs(len(scored) - 0.2 * distinct) <= 2
    metrics = {(r.model, r.metric): r.value for r in read_runs(spark, out.runs_path).collect()}
    assert metrics[out.best, "rows"] == 200 and (out.best, "predict_seconds") in metrics


def test_search_queries_cover_the_whole_space(spark, monkeypatch):
    """The maps that reach the cross-validation are drawn from BOOSTER_SPACE."""
    from types import SimpleNamespace

    from sievekit.plans import ml_catalog
    tried = []

    def searched(est, maps, rows):
        tried.extend(maps)
        return SimpleNamespace(avgMetrics=[0.5] * len(maps), stdMetrics=[0.1] * len(maps))

    monkeypatch.setattr(training, "cross_validate", searched)
    assert ml_catalog.q_m9(spark, SF0001, trials=20).count() == 20
    values = {p.name: [m[p] for m in tried] for p in tried[0]}
    rounds, depth = values["maxIter"], values["maxDepth"]
    assert set(rounds) <= set(range(400, 1401, 200)) and max(rounds) > 1000
    assert min(depth) >= 4 and max(depth) > 10
