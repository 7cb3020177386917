"""Exact duplicate detection that shuffles hashes, not rows.

Equal rows have equal hashes, so a row whose 128-bit hash occurs once is
unique. The first pass groups only the hash pair (map-side combined) and writes
the pairs that repeat; the second joins them back, so full rows move only if
their hash repeats. The exact comparison (and any hash collision) is settled by
a group-by on all columns. Spark broadcasts the repeating pairs if they are
small and shuffles otherwise; the rows are the same.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from sievekit.functions.names import col, quoted
from sievekit.session import work_dir


def _norm(df: DataFrame, c: str) -> Column:
    """Value as the group-by sees it: -0.0 == 0.0 and one NaN."""
    x = col(c)
    if isinstance(df.schema[c].dataType, (DoubleType, FloatType)):
        return F.when(F.isnan(x), F.lit(float("nan")).cast(df.schema[c].dataType)).otherwise(x + 0.0)
    return x


def with_row_hash(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """128 bits over the values and over where they are null: the hash functions
    themselves pass over nulls, so (1, null) and (null, 1) would agree."""
    vals = [x for c in cols for x in (col(c).isNull(), _norm(df, c))]
    return df.withColumn("_h1", F.xxhash64(*vals)).withColumn("_h2", F.xxhash64(F.lit(1), *vals))


def repeated_hash_keys(hashed: DataFrame) -> DataFrame:
    """Hash pairs of more than one row, written once."""
    keys = (hashed.groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n"))
                  .where("_n > 1").select("_h1", "_h2"))
    path = work_dir(hashed.sparkSession, "repeats")
    keys.write.parquet(path)
    return hashed.sparkSession.read.schema(keys.schema).parquet(path)


def duplicate_count(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first of each identical (key) row, as one row
    ``n_duplicates``: all rows less the distinct ones. Rows are grouped by hash
    and key, so the partial aggregate compares hashes first."""
    cols = list(keys or df.columns)
    hashed = with_row_hash(df.select(*[col(c) for c in cols]), cols)
    rep = repeated_hash_keys(hashed)
    g = (hashed.join(rep, ["_h1", "_h2"], "left_semi")
               .groupBy("_h1", "_h2", *[col(c) for c in cols]).agg(F.count(F.lit(1)).alias("_rows")))
    return g.agg(F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).cast("bigint").alias("n_duplicates"))


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Whole-row distinct: unique-hash rows pass through; only rows of repeating
    hash groups are de-duplicated by a group-by."""
    hashed = with_row_hash(df, df.columns)
    rep = repeated_hash_keys(hashed)
    unique = hashed.join(rep, ["_h1", "_h2"], "left_anti").drop("_h1", "_h2")
    dups = hashed.join(rep, ["_h1", "_h2"], "left_semi").drop("_h1", "_h2").dropDuplicates()
    return unique.unionByName(dups)


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    """One row per key, that with the smallest ``order_by`` (null last); of rows
    that tie, the smallest by their columns in the table's order (null first;
    columns that hold maps, which have no order, are passed over).

    Keys are compared by 128-bit hashes (two of 1e10 keys agree with odds below
    1e-18). The smallest order value and the number of rows that have it come
    from hash aggregates over (hash, order value); rows are picked by a join on
    them. Only keys whose first place is tied need another grouping."""
    hashed = with_row_hash(df, keys)
    o = col(order_by)
    first = (hashed.groupBy("_h1", "_h2", o.alias("_o")).agg(F.count(F.lit(1)).alias("_n"))
                   .groupBy(F.col("_h1").alias("_g1"), F.col("_h2").alias("_g2"))
                   .agg(F.min("_o").alias("_o"), F.coalesce(F.min_by("_n", "_o"), F.max("_n")).alias("_ties")))
    path = work_dir(df.sparkSession, "first")
    first.write.parquet(path)
    first = df.sparkSession.read.schema(first.schema).parquet(path)

    def at(firsts: DataFrame) -> DataFrame:
        return hashed.join(firsts, (F.col("_h1") == F.col("_g1")) & (F.col("_h2") == F.col("_g2"))
                           & o.eqNullSafe(F.col("_o")), "left_semi")

    out = at(first.where("_ties = 1"))
    tied = first.where("_ties > 1")
    if not tied.isEmpty():
        ordered = [_norm(df, c) for c in df.columns if "map<" not in df.schema[c].dataType.simpleString()]
        whole = F.struct(*[col(c) for c in df.columns])
        least = at(tied).groupBy("_h1", "_h2").agg(F.min_by(whole, F.struct(*ordered)).alias("_row"))
        out = out.select(*[col(c) for c in df.columns]).unionByName(least.select("_row.*"))
    return out.select(*[quoted(c) for c in df.columns])
