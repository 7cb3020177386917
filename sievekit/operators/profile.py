"""Profiling aggregates (P1-P8). Each is one scan with partial aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from sievekit.functions.names import col, text_literal
from sievekit.operators.quantiles import clean_double


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Column names whose type is numeric, in schema order."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in exclude]


def _missing(df: DataFrame, c: str):
    dt = df.schema[c].dataType
    x = F.col(f"`{c}`")
    if isinstance(dt, NumericType):
        return clean_double(x).isNull()
    return x.isNull()


def shape(df: DataFrame) -> DataFrame:
    """One row (n_rows, n_cols)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_cols", F.lit(len(df.columns)).cast("bigint"))


def missing_per_column(df: DataFrame, cols: Sequence[str] | None = None,
                       only_positive: bool = True) -> DataFrame:
    """Long (column, n_missing); null and NaN both count as missing."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(_missing(df, c)).alias(f"m{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"{text_literal(c)}, m{i}" for i, c in enumerate(cols))
    long = wide.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, n_missing)")
    return long.where("n_missing > 0") if only_positive else long


def missing_total(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row with the sum over all columns."""
    cols = list(cols or df.columns)
    total = sum((F.count_if(_missing(df, c)).cast("bigint") for c in cols), F.lit(0).cast("bigint"))
    return df.agg(total.alias("n_missing"))


def duplicate_count(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first of each identical (key) row; null equals null.

    Hash-first (see ``dedup``): only hashes are shuffled for unique rows; a hot
    duplicate collapses in the map-side partial count."""
    from sievekit.operators.dedup import duplicate_count as _hash_first
    return _hash_first(df, keys)


def label_distribution(df: DataFrame, label: str) -> DataFrame:
    """P5: count per class, sorted by class, nulls excluded."""
    return (df.where(col(label).isNotNull()).groupBy(col(label))
              .agg(F.count(F.lit(1)).alias("n")).orderBy(col(label)))


def label_moments(df: DataFrame, label: str) -> DataFrame:
    """Mean and sample standard deviation (ddof=1) of the label."""
    y = col(label).cast("double")
    return df.agg(F.avg(y).alias("label_mean"), F.stddev_samp(y).alias("label_std"))


def class_count(df: DataFrame, label: str) -> DataFrame:
    """Number of distinct non-null labels (exact)."""
    return df.agg(F.count_distinct(col(label)).alias("n_classes"))


def profile(df: DataFrame, label: str) -> dict:
    """Shape, missing total, duplicates and label moments as driver scalars (one
    row each), and the label counts as a table."""
    sh = shape(df).first()
    return {
        "n_rows": sh["n_rows"], "n_cols": sh["n_cols"], "columns": df.columns,
        "missing": missing_total(df).first()["n_missing"],
        "duplicates": duplicate_count(df).first()["n_duplicates"],
        "label_counts": label_distribution(df, label),
        **label_moments(df, label).first().asDict(),
    }
