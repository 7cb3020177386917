from sievekit.operators import evaluation, selection, voting


def test_report_never_predicted_class(spark):
    df = spark.createDataFrame([(0, 1), (1, 1), (2, 2), (2, 2)], "y int, p int")
    rep = {r["class"]: r for r in evaluation.classification_report(df, "y", "p").collect()}
    assert rep["0"].precision == 0.0 and rep["0"].f1_score == 0.0 and rep["0"].support == 1
    assert rep["1"].precision == 0.5 and rep["1"].recall == 1.0
    assert rep["accuracy"].f1_score == 0.75
    flat = {r.metric_name for r in evaluation.flatten_report(evaluation.classification_report(df, "y", "p")).collect()}
    assert "macro avg_f1-score" in flat and not any(m.endswith("support") for m in flat)


def test_confusion_has_zero_cells(spark):
    df = spark.createDataFrame([(0, 1), (1, 1), (2, 2)], "y int, p int")
    long = evaluation.confusion_long(df, "y", "p").collect()
    assert len(long) == 9 and sum(r.n for r in long) == 3
    wide = evaluation.confusion_matrix(df, "y", "p").collect()
    assert [r.label for r in wide] == ["true_0", "true_1", "true_2"]
    assert tuple(wide[0])[1:] == (0, 1, 0)


def test_confusion_class_only_predicted(spark):
    """Class 3 is never a true label, class 0 never predicted: both get a full row/column."""
    df = spark.createDataFrame([(0, 1), (1, 3), (2, 2), (2, 3)], "y int, p int")
    long = {(r.true_label, r.pred_label): r.n for r in evaluation.confusion_long(df, "y", "p").collect()}
    assert len(long) == 16 and long[(3, 3)] == 0 and long[(2, 3)] == 1 and sum(long.values()) == 4
    wide = {r.label: tuple(r)[1:] for r in evaluation.confusion_matrix(df, "y", "p").collect()}
    assert wide == {"true_0": (0, 1, 0, 0), "true_1": (0, 0, 0, 1), "true_2": (0, 0, 1, 1),
                    "true_3": (0, 0, 0, 0)}


def test_leaderboard_first_position_wins_ties(spark):
    res = spark.createDataFrame([("a", 1, 0.5), ("b", 2, 0.7), ("c", 3, 0.7)], "model string, position int, f1_score double")
    assert evaluation.best_model(res).first().model == "b"
    ranks = {r.model: r.rank for r in evaluation.leaderboard(res).collect()}
    assert ranks == {"b": 1, "c": 2, "a": 3}


def test_cv_summary_and_improvement(spark):
    s = spark.createDataFrame([("m", 0.6), ("m", 0.8)], "model string, score double")
    r = evaluation.cv_summary(s).first()
    assert abs(r.cv_mean - 0.7) < 1e-12 and abs(r.cv_two_std - 0.2) < 1e-12
    v = spark.range(1).select(evaluation.improvement_pct(__import__("pyspark.sql.functions", fromlist=["lit"]).lit(0.6454)).alias("x")).first().x
    assert v == 0.0


def test_soft_vote_long_ties_to_lowest_class(spark):
    probs = spark.createDataFrame([(1, "a", 0, 0.5), (1, "a", 1, 0.5), (1, "b", 0, 0.25), (1, "b", 1, 0.75)],
                                  "id int, model string, class int, p double")
    r = voting.soft_vote_long(probs, "id", "class", "p").first()
    assert (r.prediction, r.confidence) == (1, 0.625)
    tie = spark.createDataFrame([(1, "a", 0, 0.5), (1, "a", 1, 0.5)], "id int, model string, class int, p double")
    assert voting.soft_vote_long(tie, "id", "class", "p").first().prediction == 0


def test_soft_vote_long_takes_every_class(spark):
    """Absent (id, class) pairs, and any number of classes."""
    rows = [(i, m, c, ((i * 7 + m * 3 + c) % 5) / 8.0) for i in range(40) for m in range(3)
            for c in range(1500 if i == 0 else 4) if not (i % 9 == 0 and c == 2)]
    got = {r.id: (r.prediction, r.confidence) for r in voting.soft_vote_long(
        spark.createDataFrame(rows, "id int, model int, class int, p double"), "id", "class", "p").collect()}
    means = {}
    for i, _, c, p in rows:
        means.setdefault((i, c), []).append(p)
    want = {}
    for (i, c), ps in sorted(means.items()):
        if i not in want or sum(ps) / len(ps) > want[i][1]:
            want[i] = (c, sum(ps) / len(ps))
    assert got == want


def test_soft_vote_arrays_row_local(spark):
    df = spark.createDataFrame([([0.2, 0.8], [0.6, 0.4], [0.5, 0.5])], "a array<double>, b array<double>, c array<double>")
    r = voting.soft_vote_arrays(df, ["a", "b", "c"]).first()
    assert r.pred_index == 1 and abs(sum(r.probs) - 1.0) < 1e-12


def test_anova_and_select_k(spark):
    df = spark.createDataFrame([(0, 1.0, 5.0, 1.0), (0, 2.0, 5.1, 2.0), (1, 10.0, 5.0, 1.5), (1, 11.0, 5.2, 1.6)],
                               "y int, a double, b double, c double")
    f = {r.feature: r.f_value for r in selection.anova_f(df, ["a", "b", "c"], "y").collect()}
    assert abs(f["a"] - 162.0) < 1e-9
    assert selection.select_k_best(df, ["a", "b", "c"], "y", 2) == ["a", "b"] or \
        selection.select_k_best(df, ["a", "b", "c"], "y", 2) == ["a", "c"]


def test_robust_scaler_zero_iqr(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (10.0, 5.0)], "a double, b double")
    m = selection.fit_robust_scaler(df, ["a", "b"])
    assert m.stats == {"a": (2.5, 3.0), "b": (5.0, 1.0)}


def test_confusion_and_report_string_classes(spark):
    df = spark.createDataFrame([("low", "low"), ("high x", "low"), ("high x", "high x"), ("mid", "high x")],
                               "y string, p string")
    long = {(r.true_label, r.pred_label): r.n for r in evaluation.confusion_long(df, "y", "p").collect()}
    assert len(long) == 9 and long[("high x", "low")] == 1 and long[("mid", "mid")] == 0
    wide = {r.label: tuple(r)[1:] for r in evaluation.confusion_matrix(df, "y", "p").collect()}
    # sorted classes: 'high x' (0), 'low' (1), 'mid' (2)
    assert wide == {"true_0": (1, 1, 0), "true_1": (0, 1, 0), "true_2": (1, 0, 0)}
    rep = {r["class"]: r for r in evaluation.classification_report(df, "y", "p").collect()}
    assert rep["mid"].support == 1 and rep["mid"].precision == 0.0 and rep["accuracy"].f1_score == 0.5


def test_missing_predictions_are_wrong(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, None), (2, None), (None, 1)], "y int, p int")
    assert evaluation.accuracy(df, "y", "p").first()[0] == 0.25
    rep = {r["class"]: r for r in evaluation.classification_report(df, "y", "p").collect()}
    assert rep["1"].support == 3 and rep["2"].support == 1 and rep["accuracy"].f1_score == 0.25
    assert rep["1"].recall == 1 / 3 and rep["1"].precision == 1.0
    w = evaluation.weighted_f1(df, "y", "p").first()[0]
    assert abs(w - rep["weighted avg"].f1_score) < 1e-12


def test_many_classes_keep_their_order_and_quotes_are_values(spark):
    df = spark.createDataFrame([(i, (i + i % 2) % 12) for i in range(12)], "y int, p int")
    wide = evaluation.confusion_matrix(df, "y", "p").collect()
    assert [r.label for r in wide] == [f"true_{i}" for i in range(12)] and wide[11].pred_0 == 1
    odd = spark.createDataFrame([("it's", "it's"), ("a`b", "it's"), ("c.d", "c.d")], "`y.x` string, `p.x` string")
    long = {(r.true_label, r.pred_label): r.n for r in evaluation.confusion_long(odd, "y.x", "p.x").collect()}
    assert long[("a`b", "it's")] == 1 and len(long) == 9
    assert evaluation.confusion_matrix(odd, "y.x", "p.x").count() == 3


def test_report_is_one_scan(spark):
    from tests.conftest import SF001
    from sievekit.plans.catalog import model1
    plan = evaluation.classification_report(model1(spark, SF001), "y", "pred")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_reserved_class_name_is_an_error(spark):
    import pytest
    df = spark.createDataFrame([("accuracy", "x")], "y string, p string")
    with pytest.raises(Exception, match="reserved class name"):
        evaluation.classification_report(df, "y", "p").collect()


def test_anova_edges(spark):
    """A separating feature, a constant, as many rows as classes, dotted names."""
    df = spark.createDataFrame([(0, 1.0, 5.0, 1.0), (0, 1.0, 5.0, 2.0), (1, 9.0, 5.0, 1.5), (1, 9.0, 5.0, 1.7)],
                               "y int, `a.b` double, c double, `it's` double")
    f = {r.feature: r.f_value for r in selection.anova_f(df, ["a.b", "c", "it's"], "y").collect()}
    assert f["a.b"] == float("inf") and f["c"] is None and 0 <= f["it's"] < 10
    assert selection.select_k_best(df, ["c", "it's", "a.b"], "y", 1) == ["a.b"]
    few = spark.createDataFrame([(0, 1.0), (1, 2.0)], "y int, x double")
    assert selection.anova_f(few, ["x"], "y").first().f_value is None
