"""Table scans and sinks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sievekit.operators.cleaning import normalise_missing


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_table(spark: SparkSession, path: str, schema: StructType | str | None = None,
               fmt: str | None = None, rename: Mapping[str, str] | None = None,
               normalise: bool = True, bad_fields: str = "null") -> DataFrame:
    """S1 (+S2, F1): CSV with header or Parquet, explicit schema, NaN/empty -> null,
    dotted raw names renamed at the scan. CSV fields that don't parse become null,
    or end the job with ``bad_fields="error"``."""
    if bad_fields not in ("null", "error"):
        raise ValueError("bad_fields is 'null' or 'error'")
    fmt = fmt or ("csv" if path.endswith(".csv") else "parquet")
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        df = r.option("header", True).option("nanValue", "NaN").option("mode", "PERMISSIVE" if bad_fields == "null" else "FAILFAST").csv(path)
    else:
        df = r.format(fmt).load(path)
    if rename:
        df = df.withColumnsRenamed({k: v for k, v in rename.items() if k in df.columns})
    return normalise_missing(df) if normalise else df


def attach_label(features: DataFrame, labels: DataFrame, id_col: str,
                 how: str = "inner") -> DataFrame:
    """S3: features + label by an explicit row id (Spark has no row order).
    ``how="left"`` keeps rows without a label.

    A sort-merge/shuffle-hash equi-join on the id; Catalyst picks broadcast only
    when statistics prove one side small."""
    return features.join(labels, id_col, how)


def write_split(df: DataFrame, path: str, split_col: str = "split", mode: str = "overwrite") -> str:
    """One table partitioned by split (train/test), not four positional files."""
    df.write.mode(mode).partitionBy(split_col).parquet(path)
    return path


def read_split(spark: SparkSession, path: str, split: str | None = None,
               split_col: str = "split") -> DataFrame:
    """Read back one split; the predicate prunes the other partition."""
    df = spark.read.parquet(path)
    return df.where(F.col(split_col) == split) if split is not None else df


def write_confusion(confusion_wide: DataFrame, path: str, mode: str = "overwrite") -> str:
    """The K x K matrix as one CSV with header (K is bounded)."""
    confusion_wide.coalesce(1).write.mode(mode).option("header", True).csv(path)
    return path
