"""End-to-end flows of the reference, composed from the operators.

* ``prepare_data``   - impute -> sequential IQR -> rename -> stratified split -> write (one table)
* ``train_baseline`` - forest on the train split -> report, confusion CSV, runs table, saved model
* ``run_experiment`` - profile -> de-duplicate -> IQR -> features -> k-best (fit on train rows)
                       -> several models + soft vote, timed -> leaderboard -> runs table
                       -> best model saved as one pipeline and loaded again
* ``score_requests`` - completeness -> rename -> logarithms -> vector -> probabilities -> label, tier

Each step is a distributed job; the driver only sees bounded scalars (bounds,
k feature names, one metric row per model).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievekit.functions import features as fx
from sievekit.functions.names import col, quoted
from sievekit.functions.vectors import argmax_first
from sievekit.operators import cleaning, evaluation, profile, selection, splitting
from sievekit.plans import training
from sievekit.plans.stages import AssembleColumns, SoftVote, as_array
from sievekit.session import work_dir
from sievekit.sources.artifacts import load_model, save_model, write_metrics
from sievekit.sources.tables import read_split, write_confusion, write_split


def prepare_data(df: DataFrame, label: str, id_col: str, out_path: str,
                 rename: Mapping[str, str] | None = None, test_size: float = 0.2,
                 seed: int = 42, method: str = "exact") -> dict:
    """The data stage: median-impute columns with nulls (label included),
    sequential IQR filter on numeric non-label columns, rename, exact stratified
    split, written once as a table partitioned by ``split``. Names may hold dots
    and spaces; the filter passes read a written table of the filled rows."""
    numeric = profile.numeric_columns(df, exclude=[id_col])
    filled, medians = cleaning.impute_median(df, numeric, method=method)
    feats = [c for c in numeric if c != label]
    kept, report = cleaning.filter_outliers(filled, feats, label=label, method=method, checkpoint=True)
    if rename:
        kept = kept.withColumnsRenamed({k: v for k, v in rename.items() if k in kept.columns})
    sp = splitting.stratified_holdout(kept, label, id_col, test_size, seed)
    write_split(sp, out_path)
    return {"path": out_path, "medians": medians, "outliers": report}


def train_baseline(spark: SparkSession, split_path: str, features: Sequence[str], label: str, id_col: str,
                   model_dir: str, runs_path: str, confusion_path: str,
                   num_trees: int = 100, max_depth: int = 10, seed: int = 42) -> dict:
    """The model stage: forest pipeline fitted on the train split, scored on the
    test split; accuracy + per-class report to the runs table, K x K confusion
    CSV, pipeline saved. The forest counts its rows by their bins, and the test
    split is scored once."""
    train = read_split(spark, split_path, "train")
    test = read_split(spark, split_path, "test")
    lm = training.fit_label_map(train, label, "label_idx")
    pipe = training.model_pipeline(features, lm, training.counted_forest(num_trees, max_depth, seed))
    model = pipe.fit(train)
    path, told = work_dir(spark, "scored"), model.transform(test).select(quoted(label), "predicted_label")
    told.write.parquet(path)
    scored = spark.read.schema(told.schema).parquet(path)
    acc = evaluation.accuracy(scored, label, "predicted_label").first()["accuracy"]
    rep = evaluation.classification_report(scored, label, "predicted_label")
    run = write_metrics(spark, runs_path, "random_forest", report_metrics(rep))
    write_metrics(spark, runs_path, "random_forest", {"accuracy": acc}, run_id=run)
    write_confusion(evaluation.confusion_matrix(scored, label, "predicted_label"), confusion_path)
    save_model(model, model_dir)
    return {"run_id": run, "accuracy": acc, "model": model_dir}


def report_metrics(report: DataFrame) -> DataFrame:
    """A classification report as (class, metric, value) rows of the runs table."""
    return report.where(F.col("class") != "accuracy").selectExpr(
        "class", "stack(3, 'precision', precision, 'recall', recall, 'f1-score', f1_score) as (metric, value)")


@dataclass
class Experiment:
    """What a run leaves: ``board`` (one row per model, ranked), ``scored``
    (the loaded best model's hold-out predictions beside those it made before it
    was saved), the runs table's and the model's paths, and the profile."""
    board: DataFrame
    scored: DataFrame
    best: str
    runs_path: str
    model_path: str
    profile: dict


def run_experiment(spark: SparkSession, df: DataFrame, features: Sequence[str], label: str,
                   id_col: str, k_best: int | None = None, fit_on: str = "train",
                   engineer: Callable[[DataFrame], DataFrame] | None = None, seed: int = 42,
                   work: str | None = None, trees: int = 100, boosted_rounds: int = 100,
                   svm_rounds: int = 100) -> Experiment:
    """The full experiment. ``engineer`` adds derived features (e.g.
    :func:`sievekit.functions.features.engineered_features` on the canonical
    schema); ``fit_on='all'`` reproduces the reference's selection leak. Rows
    that agree in everything but the id are repeats; the lowest id stays."""
    work = work or work_dir(spark, "experiment")
    facts = profile.profile(df, label)
    base = cleaning.drop_exact_duplicates(df, id_col=id_col)
    kept, _ = cleaning.filter_outliers(base, list(features), label=label, count_outliers=False, checkpoint=True)
    feat_df = engineer(kept) if engineer else kept
    derived = [c for c in feat_df.columns if c not in kept.columns]
    all_feats = [c for c in list(features) + derived if c not in (label, id_col)]
    path = write_split(splitting.stratified_holdout(feat_df, label, id_col, 0.2, seed), f"{work}/split")
    train, test = read_split(spark, path, "train"), read_split(spark, path, "test")
    chosen = list(all_feats)
    if k_best and k_best < len(all_feats):
        chosen = selection.select_k_best(train if fit_on == "train" else feat_df, all_feats, label, k_best)

    lm = training.fit_label_map(train, label, "label_idx")
    k = len(lm.labels)
    vector = AssembleColumns.of(chosen)
    scale = selection.fit_robust_scaler(train, chosen).stage("_s")
    scaled = AssembleColumns.of([c + "_s" for c in chosen], "features_s")
    ready = PipelineModel([vector, scale, scaled])
    fit_rows = training.spread(ready.transform(lm.encode(train)), id_col).cache()
    fit_rows.count()                      # filled before the first model is timed

    def ensemble(est, tag):
        return lambda rows: est.setProbabilityCol(f"p_{tag}").setRawPredictionCol(f"r_{tag}") \
            .setPredictionCol(f"y_{tag}").fit(rows)

    fits = {
        "random_forest": ("p_rf", ensemble(training.forest(trees, 10, seed), "rf")),
        "extra_trees": ("p_et", ensemble(training.extra_trees(trees, None, seed), "et")),
        "gradient_boosting": ("p_gb", lambda rows: training.fit_boosted_prob(
            rows, k, maxIter=boosted_rounds, maxDepth=3, seed=seed, out="p_gb")),
        "linear_svm": ("p_svm", lambda rows: training.fit_margin_prob(
            rows, k, features_col="features_s", max_iter=svm_rounds, out="p_svm")),
    }
    models, seconds = {}, {}
    for name, (_, fit) in fits.items():
        models[name], seconds[name] = training.timed_fit(fit, fit_rows)
    fit_rows.unpersist()
    vote = SoftVote.of([p for p, _ in fits.values()])
    pipelines = {name: PipelineModel([ready, m, SoftVote.of([fits[name][0]])]) for name, m in models.items()}
    pipelines["soft_vote"] = PipelineModel([ready, *models.values(), vote])
    seconds["soft_vote"] = sum(seconds.values())
    predict_seconds = {name: training.timed_predict(p, test) for name, p in pipelines.items()}

    truth = lm.encode(test)
    own = None
    for i, (name, p) in enumerate(pipelines.items(), start=1):
        rows = p.transform(truth).select(F.col("label_idx").alias("y"), F.lit(name).alias("model"),
                                         F.lit(i).alias("position"), F.col("pred_index").alias("p"))
        own = rows if own is None else own.unionByName(rows)
    results = evaluation.per_model_scores(own, "model", "y", "p", keys=["position"])
    times = spark.createDataFrame([(n, seconds[n], predict_seconds[n]) for n in pipelines],
                                  "model string, train_seconds double, predict_seconds double")
    board_path = f"{work}/board"
    (evaluation.leaderboard(results, "f1_score", "position").join(times, "model")
               .withColumn("improvement_pct", evaluation.improvement_pct("accuracy"))
               .write.parquet(board_path))
    board = spark.read.parquet(board_path)
    best = board.orderBy("rank").first()["model"]

    runs = f"{work}/runs"
    for r in board.collect():             # a row per model
        write_metrics(spark, runs, r["model"], {m: r[m] for m in (
            "accuracy", "f1_score", "improvement_pct", "train_seconds", "predict_seconds")})
    write_metrics(spark, runs, best, {"rows": facts["n_rows"], "missing": facts["missing"],
                                      "duplicates": facts["duplicates"], "selected_features": len(chosen)})
    model_path = save_model(PipelineModel([pipelines[best], lm.decoder_stage("pred_index", "prediction")]),
                            f"{work}/best")
    loaded = load_model(model_path)
    before = pipelines[best].transform(test).select(col(id_col).alias("_id"), F.col("pred_index").alias("saved_index"))
    after = loaded.transform(test).select(quoted(id_col), quoted(label), "prediction", "confidence", "pred_index")
    scored = (after.join(before, col(id_col) == F.col("_id")).drop("_id")
                   .withColumn("same", F.col("pred_index") == F.col("saved_index")).drop("pred_index", "saved_index"))
    return Experiment(board, scored, best, runs, model_path, facts)


def score_requests(requests: DataFrame, rename: Mapping[str, str], logs: Sequence[str], model,
                   labels: Sequence, keep: Sequence[str] = ()) -> DataFrame:
    """A table of scoring requests as the service takes them one by one:
    complete rows only (C8), canonical names (F1), logarithms of ``logs`` (F5),
    feature vector in the order of ``rename`` plus the logarithms (F10),
    probabilities by ``model`` (anything with ``transform`` that adds
    ``probability``), label and confidence (I1), tier (F11) and percent (F12)."""
    checked = cleaning.require_complete(requests, list(rename))
    df = fx.rename_features(checked.where("accepted").drop("missing_fields", "accepted"), rename)
    df = df.withColumns({f"log_{c}": fx.log1p(c) for c in logs})
    df = AssembleColumns.of([*rename.values(), *[f"log_{c}" for c in logs]]).transform(df)
    scored = model.transform(df)
    index, top = argmax_first(as_array(scored, "probability"))
    values = F.array(*[F.lit(v) for v in labels])
    return (scored.withColumn("prediction", F.get(values, index)).withColumn("confidence", top)
                  .select(*keep, "prediction", "confidence", fx.quality_tier("prediction").alias("tier"),
                          fx.confidence_pct("confidence").alias("confidence_pct")))
