"""I3 with state: scoring requests that may come twice or late.

A request is scored once: rows whose id was seen within the watermark's delay
are dropped by Spark's own state. Rows that are older than the delay when they
come go to a quarantine table. Running evaluation (V1, V3) keeps one K x K table
of counts per batch, named by the batch: a batch that is run again after a
failure replaces its own rows, so nothing counts twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

COUNTS = "label string, prediction string, n long"


def _horizon(spark: SparkSession, path: str, batch: int):
    """The latest time seen before ``batch`` (null: none): what lateness is measured by."""
    try:
        seen = spark.read.schema("latest timestamp, batch long").parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return seen.where(F.col("batch") < batch).agg(F.max("latest")).first()[0]


def serve(spark: SparkSession, in_dir: str, schema: StructType | str, transform: Callable[[DataFrame], DataFrame], base: str,
          id_col: str, time_col: str, delay: str, label_col: str | None = None, prediction_col: str = "prediction",
          max_files_per_trigger: int | None = None, before_commit: Callable[[int], None] = lambda batch: None):
    """Scores what is new in ``in_dir`` and stops. Tables below ``base``, all
    partitioned by ``batch``: ``scored``, ``late`` and, with ``label_col``,
    ``counts``. ``delay`` is an interval ('10 minutes'): a row is late if its time
    is that or more before the latest one of earlier batches, or null.
    ``before_commit`` is called at a batch's end.

    Two streams, one after the other. The first sorts late rows out and writes
    the others; the second reads whole batches of the first, so its watermark
    finds no row late that the first has let through."""
    options = {"maxFilesPerTrigger": max_files_per_trigger} if max_files_per_trigger else {}
    arrived = spark.readStream.schema(schema).options(**options).parquet(in_dir)

    def write(df: DataFrame, path: str):
        df.write.mode("overwrite").parquet(f"{base}/{path}")         # a batch run again replaces its own folder

    def admit(df: DataFrame, batch: int):
        horizon = F.lit(_horizon(df.sparkSession, f"{base}/seen", batch)).cast("timestamp")
        late = F.col(time_col).isNull() | F.coalesce(F.col(time_col) <= horizon - F.expr(f"INTERVAL {delay}"), F.lit(False))
        write(df.where(late), f"late/batch={batch}")
        write(df.where(~late), f"admitted/{batch}")
        write(df.agg(F.max(time_col).alias("latest")), f"seen/batch={batch}")
        before_commit(batch)

    def score(df: DataFrame, batch: int):
        write(transform(df), f"scored/batch={batch}")
        if label_col:
            kept = df.sparkSession.read.parquet(f"{base}/scored/batch={batch}").where(F.col(label_col).isNotNull())
            write(kept.groupBy(F.col(label_col).cast("string").alias("label"), F.col(prediction_col).cast("string").alias("prediction"))
                      .agg(F.count(F.lit(1)).alias("n")), f"counts/batch={batch}")
        before_commit(batch)

    def go(rows: DataFrame, run, name: str):
        (rows.writeStream.foreachBatch(run).option("checkpointLocation", f"{base}/checkpoint-{name}")
             .trigger(availableNow=True).start().awaitTermination())

    go(arrived, admit, "admit")
    admitted = spark.readStream.schema(arrived.schema).parquet(f"{base}/admitted/*")
    go(admitted.withWatermark(time_col, delay).dropDuplicatesWithinWatermark([id_col]), score, "score")


def running_accuracy(spark: SparkSession, base: str) -> DataFrame:
    """V1 over all batches: ``accuracy``, ``n``."""
    counts = spark.read.schema(COUNTS).parquet(f"{base}/counts")
    hit = F.sum(F.when(F.col("label").eqNullSafe(F.col("prediction")), F.col("n")).otherwise(0))
    return counts.agg((hit / F.sum("n")).alias("accuracy"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def running_counts(spark: SparkSession, base: str) -> DataFrame:
    """The confusion table over all batches: (label, prediction, n)."""
    return spark.read.schema(COUNTS).parquet(f"{base}/counts").groupBy("label", "prediction").agg(F.sum("n").alias("n"))
