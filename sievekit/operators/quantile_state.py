"""C1, C2 on growing data: quantiles from stored per-file sketches.

Every file is read once. Its KLL sketches (one per column) are appended to the
state; quantiles merge the sketches of the files there are now, so new files
cost a pass over themselves alone, and a removed or rewritten file takes its old
sketches with it. A file is known by path, length and time (``sources.digests``
finds rewritten files that keep both).

A sketch of size ``k`` takes some 20 bytes times k, whatever its file holds; a
merged quantile's rank is off by at most ``rank_error(k)`` of the rows with 99 %
confidence. Sketches choose what they keep at random: two merges of the same
state may differ, within that error. Null and NaN aren't counted.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sievekit.operators.quantiles import clean_double

DEFAULT_K = 1024
FILES = "file string, size_bytes long, modified timestamp, batch string"
SKETCHES = "file string, batch string, column_name string, n long, sketch binary"


def rank_error(k: int = DEFAULT_K) -> float:
    """Greatest error of a quantile's rank, as a share of the rows, with 99 % confidence."""
    # The published error of this sketch.
    return 2.296 / k ** 0.9723


def _listing(spark: SparkSession, in_dir: str) -> DataFrame:
    """The files as the scan names them (``file``), and as a reader takes them (``path``); none is opened."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(in_dir)
                 .select("path", F.col("_metadata.file_path").alias("file"), F.col("length").alias("size_bytes"),
                         F.col("modificationTime").alias("modified")))


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _current(spark: SparkSession, in_dir: str, state_dir: str) -> DataFrame:
    """Listed files with the batch that read them as they are (null: none did)."""
    known = (_stored(spark, f"{state_dir}/files", FILES).groupBy("file", "size_bytes", "modified")
             .agg(F.min("batch").alias("batch")))          # two runs at once may both have read a file
    return _listing(spark, in_dir).join(known, ["file", "size_bytes", "modified"], "left")


def update_state(spark: SparkSession, in_dir: str, schema: StructType | str, cols: Sequence[str], state_dir: str,
                 k: int = DEFAULT_K) -> int:
    """Reads the Parquet files of ``in_dir`` that the state doesn't know, and
    says how many. A file counts as known once its sketches are written, so a run
    that fails is repeated. One state has one list of columns and one ``k``."""
    new = [r for r in _current(spark, in_dir, state_dir).where("batch IS NULL").collect()]      # file names
    if not new:
        return 0
    batch = uuid.uuid4().hex
    rows = spark.read.schema(schema).parquet(*[r["path"] for r in new])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), clean_double(c).alias("v")) for c in cols])
    (rows.select(F.col("_metadata.file_path").alias("file"), F.inline(pairs)).where(F.col("v").isNotNull())
         .groupBy("file", "column_name").agg(F.kll_sketch_agg_double("v", F.lit(k)).alias("sketch"))
         .select("file", F.lit(batch).alias("batch"), "column_name", F.kll_sketch_get_n_double("sketch").alias("n"), "sketch")
         .write.mode("append").parquet(f"{state_dir}/sketches"))
    spark.createDataFrame([(r["file"], r["size_bytes"], r["modified"], batch) for r in new], FILES) \
         .write.mode("append").parquet(f"{state_dir}/files")
    return len(new)


def state_quantiles(spark: SparkSession, in_dir: str, state_dir: str, cols: Sequence[str], probs: Sequence[float]
                    ) -> tuple[dict[str, list[float | None]], dict[str, int]]:
    """({column: quantiles}, {column: values counted}) over the files there are;
    one that hasn't been read is an error."""
    now = _current(spark, in_dir, state_dir)
    unread = now.where("batch IS NULL").count()
    if unread:
        raise ValueError(f"{unread} files are not in the state; run update_state")
    own = _stored(spark, f"{state_dir}/sketches", SKETCHES).where(F.col("column_name").isin(list(cols)))
    merged = (own.join(now.select("file", "batch"), ["file", "batch"], "left_semi").groupBy("column_name")
                 .agg(F.kll_merge_agg_double("sketch").alias("s"), F.sum("n").alias("n")))
    found = merged.select("column_name", "n", F.kll_sketch_get_quantile_double(
        "s", F.array(*[F.lit(float(p)) for p in probs])).alias("q")).collect()
    values, counts = {c: [None] * len(probs) for c in cols}, dict.fromkeys(cols, 0)
    for r in found:
        values[r["column_name"]], counts[r["column_name"]] = list(r["q"]), r["n"]
    return values, counts


def state_iqr_bounds(spark: SparkSession, in_dir: str, state_dir: str, cols: Sequence[str], k: float = 1.5
                     ) -> dict[str, tuple[float | None, float | None, float | None, float | None]]:
    """C2 from the state: {col: (q1, q3, lower, upper)}, as ``cleaning.iqr_bounds``."""
    values, _ = state_quantiles(spark, in_dir, state_dir, cols, [0.25, 0.75])
    return {c: (None,) * 4 if q1 is None else (q1, q3, q1 - k * (q3 - q1), q3 + k * (q3 - q1))
            for c, (q1, q3) in values.items()}
