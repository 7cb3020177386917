"""Exact stratified hold-out (X1) and stratified k-fold.

Class sizes, allocations and boundaries are small tables (a row per class, or
per class and hash prefix) that stay tables: they are joined to the rows, so the
number of classes has no limit and Spark broadcasts them when they are small.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievekit.functions.names import col, quoted
from sievekit.operators.ranking import (MAX_DIGITS, RANK_ROWS_PER_BUCKET, order_key, stratified_rank,
                                        sub_bucket, sub_bucket_digits)
from sievekit.session import work_dir

START_DIGITS = 2          # hex digits of the first count: 256 sub-buckets per class


def _written(df: DataFrame, name: str) -> DataFrame:
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def allocate_test(counts: DataFrame, label: str, test_size: float = 0.2) -> DataFrame:
    """Per-class test sizes for a table (label, n): adds ``t``. The total is
    ceil(test_size * n); every class gets the floor of its share, the remaining
    rows go to the largest remainders (ties to the lower class).

    Raises ValueError like the reference's library: no rows, a class with fewer
    than 2 rows, or fewer test/train rows than classes."""
    r = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"), F.count_if(F.col("n") < 2).alias("small")).first()
    n, k = r["n"] or 0, r["k"]
    if n == 0:
        raise ValueError("empty input")
    if r["small"]:
        raise ValueError(f"the least populated class has only 1 member ({r['small']} such classes)")
    n_test = math.ceil(Fraction(str(test_size)) * n)
    if n_test < k or n - n_test < k:
        raise ValueError(f"test ({n_test}) and train ({n - n_test}) sizes must be >= {k} classes")
    # exact integers: n_test * n_c = floor * n + remainder
    product = F.col("n").cast("decimal(19,0)") * F.lit(n_test).cast("decimal(19,0)")
    rest = (product % F.lit(n).cast("decimal(19,0)")).cast("decimal(38,0)")
    shares = counts.withColumn("_rest", rest).withColumn(
        "_floor", ((product.cast("decimal(38,0)") - F.col("_rest")) / F.lit(n).cast("decimal(19,0)")).cast("long"))
    left = n_test - (shares.agg(F.sum("_floor")).first()[0] or 0)
    by_remainder = Window.orderBy(F.desc("_rest"), col(label))        # a row per class
    return (shares.withColumn("t", F.col("_floor") + (F.row_number().over(by_remainder) <= left).cast("long"))
                  .drop("_rest", "_floor"))


def _bucket_counts(keyed: DataFrame, label: str, digits: int) -> DataFrame:
    return (keyed.groupBy(col(label).alias("_y"), sub_bucket(F.col("_k"), digits).alias("_sb"))
                 .agg(F.count(F.lit(1)).alias("_n")))


def _boundaries(sizes: DataFrame, want: DataFrame) -> DataFrame:
    """Per class with t > 0: the sub-bucket ``_bsb`` that holds its t-th row in
    key order, how many of its rows are wanted (``_br``), and its size ``_bn``."""
    upto = Window.partitionBy("_y").orderBy("_sb").rowsBetween(Window.unboundedPreceding, 0)
    before = F.col("_cum") - F.col("_n")
    return (sizes.join(want, "_y").withColumn("_cum", F.sum("_n").over(upto))
                 .where((before < F.col("t")) & (F.col("_cum") >= F.col("t")))
                 .select("_y", F.col("_sb").alias("_bsb"), (F.col("t") - before).alias("_br"),
                         F.col("_n").alias("_bn")))


def stratified_holdout(df: DataFrame, label: str, id_col: str, test_size: float = 0.2,
                       seed: int = 42, split_col: str = "split",
                       target_rows: int = RANK_ROWS_PER_BUCKET) -> DataFrame:
    """Adds ``split`` in {'train','test'} with exact class-proportional sizes.

    The test rows of a class are its first t rows in the order (md5(id|seed),
    id). They are selected, not sorted out:

    1. one scan counts rows per (class, first hex digits of the key), map-side
       combined; class sizes are sums of that table, and a window over it finds
       each class's boundary sub-bucket;
    2. while a boundary sub-bucket holds more than ``target_rows`` rows, only
       its rows are counted again on two more digits;
    3. rows on either side of their class's boundary are decided as they are
       read; only the boundary sub-buckets are ranked by a window.

    The table is never shuffled, and a class that holds a third of the rows
    costs the same as any other. Rows with a null label go to train. ``id_col``
    must identify rows uniquely (a repeated id's rows would tie)."""
    keyed = df.withColumn("_k", order_key(id_col, seed))
    known = keyed.where(col(label).isNotNull())
    d = START_DIGITS
    sizes = _written(_bucket_counts(known, label, d), "bucket-sizes")
    counts = sizes.groupBy("_y").agg(F.sum("_n").alias("n"))
    want = allocate_test(counts, "_y", test_size).select("_y", "t")
    bounds = _written(_boundaries(sizes, want), "boundaries")
    while (bounds.agg(F.max("_bn")).first()[0] or 0) > target_rows and d + 2 <= MAX_DIGITS:
        inside = known.join(bounds, (col(label) == F.col("_y")) & (sub_bucket(F.col("_k"), d) == F.col("_bsb")), "left_semi")
        finer = _bucket_counts(inside, label, d + 2)
        d += 2
        bounds = _written(_boundaries(finer, bounds.select("_y", F.col("_br").alias("t"))), "boundaries")
    # classes without test rows have no boundary: every row is train
    placed = (keyed.withColumn("_sb", sub_bucket(F.col("_k"), d))
                   .join(bounds, col(label) == F.col("_y"), "left"))
    cols = [quoted(c) for c in df.columns]
    at = F.coalesce(F.col("_sb") == F.col("_bsb"), F.lit(False))
    test, train = F.lit("test"), F.lit("train")
    outside = placed.where(~at).select(
        *cols, F.when(F.col("_sb") < F.col("_bsb"), test).otherwise(train).alias(split_col))
    order = Window.partitionBy(col(label)).orderBy("_k", col(id_col))
    inside = placed.where(at).select(
        *cols, F.when(F.row_number().over(order) <= F.col("_br"), test).otherwise(train).alias(split_col))
    return outside.unionByName(inside)


def stratified_kfold(df: DataFrame, label: str, id_col: str, k: int = 5, seed: int = 42,
                     fold_col: str = "fold") -> DataFrame:
    """``fold`` = (rank within class in md5 order) mod k; usable as CrossValidator.foldCol."""
    largest = (df.where(col(label).isNotNull()).groupBy(col(label)).agg(F.count(F.lit(1)).alias("n"))
                 .agg(F.max("n")).first()[0] or 0)
    if largest < k:
        raise ValueError(f"n_splits={k} cannot be greater than the number of members in each class")
    ranked = stratified_rank(df, label, id_col, seed, digits=sub_bucket_digits(largest, min_digits=3))
    return ranked.withColumn(fold_col, F.pmod(F.col("_rank"), F.lit(k)).cast("int")).drop("_rank")
