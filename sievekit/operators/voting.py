"""Soft voting (M8) and argmax scoring on probability tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievekit.functions.vectors import argmax_first


def soft_vote_arrays(df: DataFrame, prob_cols: Sequence[str], out: str = "probs") -> DataFrame:
    """Row-local average of per-model probability arrays (no shuffle), then
    argmax (first maximum on ties) -> ``pred_index``, ``confidence``."""
    m = len(prob_cols)
    arrs = [F.col(c).cast("array<double>") for c in prob_cols]
    avg = F.transform(arrs[0], lambda x, i: (x + sum((a[i] for a in arrs[1:]), F.lit(0.0))) / m) \
        if m > 1 else arrs[0]
    df = df.withColumn(out, avg)
    idx, mx = argmax_first(F.col(out))
    return df.withColumn("pred_index", idx).withColumn("confidence", mx)


def soft_vote_long(probs: DataFrame, id_col: str = "id", class_col: str = "class",
                   p_col: str = "p") -> DataFrame:
    """Long (id, model, class, p) -> (id, prediction, confidence).

    Mean probability per (id, class), then per id the class with the largest
    mean; ties go to the lowest class via min(struct(-p, class)). Any number of
    classes; every class found takes part. The rows are dealt by id once, which
    serves both aggregates (an id has at most models x classes rows)."""
    rows = probs.select(id_col, class_col, p_col).repartition(id_col)
    mean = rows.groupBy(id_col, class_col).agg(F.avg(p_col).alias("_p"))
    best = mean.groupBy(id_col).agg(F.min(F.struct((-F.col("_p")).alias("np"),
                                                   F.col(class_col).alias("c"))).alias("_b"))
    return best.select(id_col, F.col("_b.c").alias("prediction"),
                       (-F.col("_b.np")).alias("confidence"))
