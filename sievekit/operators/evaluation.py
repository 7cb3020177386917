"""Evaluation tables.

Metrics start from one small aggregate of the scored rows: pair counts
``groupBy(label, prediction)`` (<= K^2 rows) for the confusion matrix, and
``class_stats`` (<= K rows: tp, support, predicted) for the report and the
per-model scores. Both are map-side combined; everything after is a small table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievekit.functions.names import col

# Fixed value: accuracy of the reference's baseline forest, used by V10.
BASELINE_ACCURACY = 0.6454


def pair_counts(df: DataFrame, label: str, pred: str) -> DataFrame:
    """(y, p, n) over rows with a label, the long form of V2: only pairs that
    occur. A missing prediction is a pair with null."""
    return (df.where(col(label).isNotNull())
              .groupBy(col(label).alias("y"), col(pred).alias("p"))
              .agg(F.count(F.lit(1)).alias("n")))


def accuracy(df: DataFrame, label: str, pred: str) -> DataFrame:
    """V1: share of labelled rows with prediction == label; a missing
    prediction is wrong."""
    right = F.coalesce(col(label) == col(pred), F.lit(False))
    return df.where(col(label).isNotNull()).agg(F.avg(right.cast("double")).alias("accuracy"))


def class_stats(df: DataFrame, label: str, pred: str, keys: Sequence[str] = ()) -> DataFrame:
    """(keys..., c, tp, support, npred) for every class seen as label or prediction.

    One aggregate straight from the scored rows: each row adds (c=label:
    support 1, tp 1 if correct) and (c=prediction: npred 1); map-side combine
    leaves at most K rows per task and key. Rows without a label don't count; a
    missing prediction adds to its label's support only."""
    y, p = col(label), col(pred)
    parts = F.array(
        F.struct(y.alias("c"), F.lit(1).alias("s"), F.coalesce((y == p).cast("int"), F.lit(0)).alias("t"),
                 F.lit(0).alias("q")),
        F.struct(p.alias("c"), F.lit(0).alias("s"), F.lit(0).alias("t"), F.lit(1).alias("q")))
    return (df.where(y.isNotNull()).select(*[col(k) for k in keys], F.inline(parts)).where(F.col("c").isNotNull())
              .groupBy(*[col(k) for k in keys], "c").agg(F.sum("t").alias("tp"), F.sum("s").alias("support"),
                                                         F.sum("q").alias("npred")))


def class_list(df: DataFrame, label: str, pred: str) -> list:
    """Sorted union of label and prediction values: as many as the result of a
    confusion matrix has rows and columns."""
    y, p = col(label), col(pred)
    distinct = (df.where(y.isNotNull()).select(F.explode(F.array(y, p)).alias("c"))     # one scan
                  .where(F.col("c").isNotNull()).distinct())
    return sorted(r["c"] for r in distinct.collect())


def _confusion_pivot(df: DataFrame, label: str, pred: str, classes: Sequence) -> DataFrame:
    """(y, one count column per class) in one aggregate. Each row also adds a
    zero entry under its predicted class as a true label, so a class that is
    only ever predicted still gets its row (no join back to the class list).
    Rows without a prediction are in no cell."""
    y, p = col(label), col(pred)
    parts = F.array(F.struct(y.alias("y"), p.alias("p"), F.lit(1).alias("n")),
                    F.struct(p.alias("y"), F.lit(None).cast(df.schema[pred].dataType).alias("p"),
                             F.lit(0).alias("n")))
    return (df.where(y.isNotNull()).select(F.inline(parts)).where(F.col("y").isNotNull())
              .groupBy("y").pivot("p", list(classes)).agg(F.sum("n")))


def confusion_long(df: DataFrame, label: str, pred: str) -> DataFrame:
    """V2 (long): (true_label, pred_label, n) over the sorted union of classes, zero cells included.

    Zero cells come from pivoting on the class list, not from a cross join; for
    very many classes take ``pair_counts``, which has none."""
    classes = class_list(df, label, pred)
    names = [f"_c{i}" for i in range(len(classes))]
    wide = _confusion_pivot(df, label, pred, classes).toDF("y", *names)
    cells = F.array(*[F.struct(F.lit(c).cast(df.schema[pred].dataType).alias("pred_label"),
                               F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias("n"))
                      for c, n in zip(classes, names)])
    return wide.select(F.col("y").alias("true_label"), F.inline(cells))


def confusion_matrix(df: DataFrame, label: str, pred: str) -> DataFrame:
    """V2/S7 (wide): rows ``true_i``, columns ``pred_i`` by position in the
    sorted classes, rows in that order."""
    classes = class_list(df, label, pred)
    names = [f"pred_{i}" for i in range(len(classes))]
    wide = _confusion_pivot(df, label, pred, classes).toDF("y", *names)
    order = Window.orderBy("y").rowsBetween(Window.unboundedPreceding, Window.currentRow)   # K rows
    return (wide.withColumn("_i", F.count(F.lit(1)).over(order) - 1)
                .orderBy("_i")
                .select(F.concat(F.lit("true_"), F.col("_i").cast("string")).alias("label"),
                        *[F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias(n) for n in names]))


def _with_rates(per: DataFrame) -> DataFrame:
    """Adds precision, recall and f1_score to class counts; 0/0 is 0."""
    zero = F.lit(0.0)
    per = per.withColumns({
        "precision": F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("npred")), zero),
        "recall": F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support")), zero)})
    return per.withColumn("f1_score", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                                              F.col("precision") + F.col("recall")), zero))


#: rows of a report that are not classes
SUMMARY = ("accuracy", "macro avg", "weighted avg")


def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """V3: (class, precision, recall, f1_score, support) per class, then
    'accuracy', 'macro avg', 'weighted avg'. 0/0 -> 0.

    One aggregate over the scored rows. Totals are windows on its K rows; the
    first class row also emits the three summary rows, so nothing is read or
    aggregated twice. A class may not bear the name of a summary row."""
    per = _with_rates(class_stats(df, label, pred))
    every = Window.partitionBy(F.lit(0))
    weighted = {f"w_{m}": F.try_divide(F.sum(F.col(m) * F.col("support")).over(every), F.sum("support").over(every))
                for m in ("precision", "recall", "f1_score")}
    per = per.withColumns({
        "n": F.sum("support").over(every), "hits": F.sum("tp").over(every),
        **{f"m_{m}": F.avg(m).over(every) for m in ("precision", "recall", "f1_score")}, **weighted,
        "first": F.row_number().over(every.orderBy("c")) == 1})
    name = F.col("c").cast("string")
    name = F.when(name.isin(*SUMMARY), F.raise_error(F.concat(F.lit("reserved class name: "), name))).otherwise(name)

    def row(label_, p, r, f1, n):
        return F.struct(label_.alias("class"), p.cast("double").alias("precision"), r.cast("double").alias("recall"),
                        f1.cast("double").alias("f1_score"), n.cast("bigint").alias("support"))

    own = row(name, F.col("precision"), F.col("recall"), F.col("f1_score"), F.col("support"))
    none = F.lit(None)
    summary = [row(F.lit("accuracy"), none, none, F.try_divide("hits", "n"), F.col("n")),
               row(F.lit("macro avg"), F.col("m_precision"), F.col("m_recall"), F.col("m_f1_score"), F.col("n")),
               row(F.lit("weighted avg"), F.col("w_precision"), F.col("w_recall"), F.col("w_f1_score"), F.col("n"))]
    return per.select(F.inline(F.when(F.col("first"), F.array(own, *summary)).otherwise(F.array(own))))


def flatten_report(report: DataFrame) -> DataFrame:
    """V4: (metric_name, value) = '<class>_<metric>' for precision, recall and
    f1-score of every class and average; support and the scalar accuracy are skipped."""
    body = report.where(F.col("class") != "accuracy")
    long = body.selectExpr(
        "class", "stack(3, 'precision', precision, 'recall', recall, 'f1-score', f1_score) "
                 "as (metric, value)")
    return long.select(F.concat_ws("_", "class", "metric").alias("metric_name"), "value")


def weighted_f1(df: DataFrame, label: str, pred: str) -> DataFrame:
    """V5: support-weighted F1, straight from the class counts."""
    per = _with_rates(class_stats(df, label, pred))
    return per.agg(F.try_divide(F.sum(F.col("f1_score") * F.col("support")), F.sum("support")).alias("weighted_f1"))


def log_loss(df: DataFrame, label_index: str, probs: str, eps: float = 1e-15) -> DataFrame:
    """V6: mean of -ln(p of the true class), p clipped to [eps, 1-eps].

    ``label_index`` is the 0-based class index into the ``probs`` array."""
    p = F.element_at(F.col(probs), F.col(label_index) + 1).cast("double")
    p = F.least(F.greatest(p, F.lit(eps)), F.lit(1.0 - eps))
    return df.agg(F.avg(-F.ln(p)).alias("log_loss"))


def cv_summary(scores: DataFrame, model: str = "model", score: str = "score") -> DataFrame:
    """V7: mean and 2 x population std of fold scores per model."""
    return scores.groupBy(model).agg(F.avg(score).alias("cv_mean"),
                                     (2 * F.stddev_pop(score)).alias("cv_two_std"))


def per_model_scores(long: DataFrame, model: str = "model", label: str = "y",
                     pred: str = "p", keys: Sequence[str] = ()) -> DataFrame:
    """(model, accuracy, f1_score) for many models at once, from one
    per-(model, class) aggregate (<= M x K rows): one pass over the scored rows
    instead of one report per model. ``keys``: further per-model columns
    (e.g. position) carried through the grouping instead of joined back."""
    per = _with_rates(class_stats(long, label, pred, [model, *keys]))
    return per.groupBy(model, *keys).agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        (F.sum(F.col("f1_score") * F.col("support")) / F.sum("support")).alias("f1_score"))


def leaderboard(results: DataFrame, score: str = "f1_score", position: str = "position") -> DataFrame:
    """V8: models ranked by score (desc), first position wins ties. The input is
    one row per model (bounded), so the unpartitioned rank window is tiny."""
    w = Window.orderBy(F.desc(score), F.asc(position))
    return results.withColumn("rank", F.row_number().over(w))


def best_model(results: DataFrame, score: str = "f1_score", position: str = "position") -> DataFrame:
    """V8: the top-1 row of the leaderboard."""
    return results.orderBy(F.desc(score), F.asc(position)).limit(1)


def improvement_pct(acc: Column | str, baseline: float = BASELINE_ACCURACY) -> Column:
    """(acc - baseline) / baseline * 100."""
    a = F.col(acc) if isinstance(acc, str) else acc
    return (a - F.lit(baseline)) / F.lit(baseline) * 100.0


def speedup(times: DataFrame, seconds: str = "seconds") -> DataFrame:
    """Slowest time / each time."""
    slowest = times.agg(F.max(seconds)).first()[0]      # one scalar
    return times.withColumn("speedup", F.lit(slowest) / F.col(seconds))
