"""Run metrics, model persistence and input freshness."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUNS_SCHEMA = ("run_id string, ts timestamp, model string, class string, "
               "metric string, value double")


def write_metrics(spark: SparkSession, path: str, model: str,
                  metrics: Mapping[str, float] | DataFrame, run_id: str | None = None) -> str:
    """Append metrics to a ``runs`` parquet table (run_id, ts, model, class, metric, value).

    ``metrics`` is either a small dict of scalars or a long DataFrame with
    (class, metric, value) columns (e.g. a classification report), which is
    appended without passing through the driver."""
    run_id = run_id or uuid.uuid4().hex
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    if isinstance(metrics, DataFrame):
        df = metrics.select(F.lit(run_id).alias("run_id"), F.lit(now).cast("timestamp").alias("ts"),
                            F.lit(model).alias("model"), F.col("class").cast("string"),
                            F.col("metric").cast("string"), F.col("value").cast("double"))
    else:
        rows = [(run_id, now, model, None, k, float(v) if v is not None else None)
                for k, v in metrics.items()]
        df = spark.createDataFrame(rows, RUNS_SCHEMA)
    df.write.mode("append").parquet(path)
    return run_id


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUNS_SCHEMA).parquet(path)


def save_model(model, path: str) -> str:
    """Persist a fitted ``PipelineModel``; scaler, selection, per-class
    models, soft vote and label map are stages of it (``plans.stages``)."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str):
    """Load a ``PipelineModel`` saved by :func:`save_model`."""
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


def fresh_inputs(spark: SparkSession, path: str, max_age_hours: float = 24.0,
                 now: dt.datetime | None = None, pattern: str = "*") -> DataFrame:
    """Per input file, its size, modification time and whether it is younger
    than ``max_age_hours`` (file listing only; one row per file)."""
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    cutoff = now - dt.timedelta(hours=max_age_hours)
    # binaryFile lists files; without the ``content`` column no file is opened
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
                  .option("recursiveFileLookup", "true").load(path)
                  .select(F.col("path").alias("file_path"), F.col("length").alias("size_bytes"),
                          F.col("modificationTime").alias("modified")))
    return files.withColumn("is_fresh", F.col("modified") >= F.lit(cutoff).cast("timestamp"))
