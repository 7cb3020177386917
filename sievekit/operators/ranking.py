"""Per-class ranks in a seeded hash order, without one task per class.

``row_number() over (partition by label order by md5(id|seed), id)`` puts a
whole class in one task; with a class holding a third of the rows that task
is the job. Here the order key's leading hex digits split every class into
16**digits sub-buckets of near-equal size (md5 is uniform): ranks are numbered
inside each (label, sub-bucket) window and shifted by the sizes of the
earlier sub-buckets of the same class (a small table: at most K x 16**digits
rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievekit.functions.names import col

RANK_ROWS_PER_BUCKET = 1_000_000     # target rows per (class, sub-bucket) window task
MAX_DIGITS = 8                       # 16**8 sub-buckets; 8 hex digits fit a long


def sub_bucket_digits(max_class_rows: int, target: int = RANK_ROWS_PER_BUCKET,
                      min_digits: int = 1) -> int:
    """Hex digits of the order key that split the largest class into
    sub-buckets of about ``target`` rows (md5 is uniform)."""
    d = min_digits
    while d < MAX_DIGITS and max_class_rows > target * 16 ** d:
        d += 1
    return d


def sub_bucket(key: Column, digits: int) -> Column:
    return F.conv(F.substring(key, 1, digits), 16, 10).cast("long")


def order_key(id_col: str, seed: int) -> Column:
    """md5 of the id text followed by '|seed' (same in DuckDB: md5(id::varchar || '|42'))."""
    return F.md5(F.concat(col(id_col).cast("string"), F.lit(f"|{seed}")))


def stratified_rank(df: DataFrame, label: str, id_col: str, seed: int = 42,
                    digits: int = 3, rank_col: str = "_rank") -> DataFrame:
    """Adds ``rank_col``: 0-based position of the row inside its class in the
    order (md5(id|seed), id). The offsets table has a row per class and
    sub-bucket; it is joined on the window's own partitioning, so the rows are
    shuffled once, and Spark broadcasts it where it is small."""
    df = df.withColumn("_k", order_key(id_col, seed)).withColumn("_sb", sub_bucket(F.col("_k"), digits))
    sizes = df.groupBy(col(label).alias("_y"), F.col("_sb").alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_y").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    w = Window.partitionBy(col(label), "_sb").orderBy("_k", col(id_col))
    ranked = df.withColumn("_rn", F.row_number().over(w) - 1)
    return (ranked.join(offsets, (col(label) == F.col("_y")) & (F.col("_sb") == F.col("_b")), "left")
                  .withColumn(rank_col, (F.col("_off") + F.col("_rn")).cast("bigint"))
                  .drop("_k", "_sb", "_rn", "_off", "_y", "_b"))
