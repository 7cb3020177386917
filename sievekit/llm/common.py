"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievekit.session import work_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: the white space of ``[\x20\x09-\x0D]``
ASCII_SPACE = " \t\n\x0b\x0c\r"


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else. Pure-ASCII values take ``lower``,
    which equals it there and is much cheaper than a per-character map."""
    return (F.when(F.octet_length(text) == F.char_length(text), F.lower(text))
            .otherwise(F.translate(text, UPPER, LOWER)))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, whatever the optimiser
    inlines: lambda bodies would otherwise evaluate it for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def row_hash(text: Column) -> Column:
    """With the id, the identity of a row: rows that repeat an id with another
    text stay apart, full repeats count as one document."""
    return F.xxhash64(text)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` once to the cluster's shared work folder and reads it
    back: later passes neither recompute it nor depend on lost executors."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: words of a key sketch: 2^18 longs, whatever the table
SKETCH_WORDS = 1 << 18


def _slot(key: str) -> tuple[Column, Column]:
    h = F.xxhash64(key)
    return (F.shiftrightunsigned(h, 6).bitwiseAND(F.lit(SKETCH_WORDS - 1)).cast("int").alias("_word"),
            h.bitwiseAND(F.lit(63)).cast("int").alias("_bit"))


def key_sketch(keys: DataFrame, key: str) -> DataFrame:
    """One bit per hash of ``key``: at most ``SKETCH_WORDS`` rows, so it can be
    broadcast at any size of ``keys``. With very many keys it lets all through."""
    return keys.select(*_slot(key)).groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits"))


def in_sketch(df: DataFrame, key: str, sketch: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows whose ``key`` may be in the sketch (``left_anti``: surely isn't).
    Before a join it keeps rows without a partner out of the shuffle."""
    columns = df.columns
    word, bit = _slot(key)
    found = F.expr("(shiftright(_bits, _at) & 1L) = 1L")
    keyed = df.select("*", word.alias("_at_word"), bit.alias("_at"))
    return keyed.join(F.broadcast(sketch), (F.col("_at_word") == F.col("_word")) & found, how).select(*columns)
