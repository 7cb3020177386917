"""Feature selection and scaling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievekit.functions.names import col, text_literal
from sievekit.operators.quantiles import clean_double, quantiles


def anova_f(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """One-way ANOVA F per feature -> (feature, position, f_value).

    One scan builds (n, mean, var_pop) per class for all features side by side
    (K rows), unpivots that small table, and combines in the centred form
    F = [sum n_c (m_c - m)^2 / (K-1)] / [sum n_c var_c / (n-K)].

    No variance inside the classes gives infinity if their means differ; F is
    null where it is undefined (one class, one row per class, a constant).
    """
    feats = list(features)
    aggs = []
    for i, f in enumerate(feats):
        x = clean_double(f)
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.var_pop(x).alias(f"v{i}")]
    per_class = df.where(col(label).isNotNull()).groupBy(col(label)).agg(*aggs)
    stack = ", ".join(f"{text_literal(f)}, {i}, n{i}, m{i}, v{i}" for i, f in enumerate(feats))
    long = per_class.selectExpr(
        f"stack({len(feats)}, {stack}) as (feature, position, n_c, m_c, v_c)").where("n_c > 0")
    # totals per feature over its K class rows: a window on the small table,
    # so the scan feeds one plan path (no self-join re-reading the input)
    w = Window.partitionBy("feature", "position")
    j = long.withColumns({"n": F.sum("n_c").over(w), "k": F.count(F.lit(1)).over(w),
                          "m": F.sum(F.col("n_c") * F.col("m_c")).over(w) / F.sum("n_c").over(w)})
    res = j.groupBy("feature", "position", "n", "k").agg(
        F.sum(F.col("n_c") * (F.col("m_c") - F.col("m")) * (F.col("m_c") - F.col("m"))).alias("ssb"),
        F.sum(F.col("n_c") * F.col("v_c")).alias("ssw"))
    between = F.try_divide("ssb", F.col("k") - 1)
    within = F.try_divide("ssw", F.col("n") - F.col("k"))
    f_val = (F.when((within == 0) & (between > 0), F.lit(float("inf")))
              .otherwise(F.try_divide(between, within)))
    return res.select("feature", F.col("position").cast("int").alias("position"),
                      f_val.alias("f_value"))


def select_k_best(df: DataFrame, features: Sequence[str], label: str, k: int) -> list[str]:
    """The k features with the largest F, returned in original column order.

    Ties keep the later position, as ``argsort`` on the scores does."""
    return best_features(anova_f(df, features, label), k)


def best_features(scores: DataFrame, k: int) -> list[str]:
    """The k best of an ``anova_f`` table, so that scores and choice share a scan."""
    top = (scores.orderBy(F.desc_nulls_last("f_value"), F.desc("position")).limit(k)
                 .select("feature", "position").collect())      # <= k rows
    return [r["feature"] for r in sorted(top, key=lambda r: r["position"])]


class RobustScalerModel:
    """(x - median) / IQR with statistics fitted on the training rows only."""

    def __init__(self, stats: Mapping[str, tuple[float, float]]):
        self.stats = dict(stats)

    def stage(self, suffix: str = ""):
        """The same as a savable pipeline stage."""
        from sievekit.plans.stages import RobustScale
        return RobustScale.of(self.stats, suffix)

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        out = {}
        for c, (center, scale) in self.stats.items():
            out[c + suffix] = (clean_double(c) - F.lit(center)) / F.lit(scale)
        return df.withColumns(out)


def fit_robust_scaler(df: DataFrame, cols: Sequence[str], method: str = "exact",
                      quantile_range=(0.25, 0.75)) -> RobustScalerModel:
    """E3 fit: median and IQR per column (a zero IQR scales by 1, like the reference)."""
    lo, hi = quantile_range
    qs = quantiles(df, cols, [lo, 0.5, hi], method=method)
    stats = {}
    for c in cols:
        q1, med, q3 = qs[c]
        iqr = (q3 - q1) if q1 is not None else None
        stats[c] = (med, iqr if iqr else 1.0)
    return RobustScalerModel(stats)
