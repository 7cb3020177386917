"""What a stage read and wrote, by content.

A manifest is a table with a row per file: its path, length and MD5 of the bytes. A stage runs if a file it reads, a file it wrote or its
``settings`` differ from its last manifest, whatever the files' times say;
stages whose inputs come out the same stay as they are.

Files are read by Spark's ``binaryFile`` scan and hashed where they are read, so
only paths and digests move; a file above that reader's limit of 2 GB is an
error. What a stage writes must not lie inside what it reads.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "role string, name string, file string, size_bytes long, md5 string"


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(file, size_bytes, md5) of every file under ``path`` (one row for a file);
    without hidden ones, whose names begin with ``_`` or ``.``, and those of no
    bytes, which Spark's scans pass over: an emptied file is a removed one.
    Nothing there: no rows."""
    empty = spark.createDataFrame([], "file string, size_bytes long, md5 string")
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty
    return files.select(F.col("path").alias("file"), F.col("length").alias("size_bytes"), F.md5("content").alias("md5"))


def changes(now: DataFrame, last: DataFrame, keys: Sequence[str] = ("file",)) -> DataFrame:
    """The keys whose digest is new, changed or removed, with ``change``."""
    a = now.select(*keys, F.col("md5").alias("_now"), F.lit(True).alias("_a"))
    b = last.select(*keys, F.col("md5").alias("_last"), F.lit(True).alias("_b"))
    change = (F.when(F.col("_b").isNull(), "new").when(F.col("_a").isNull(), "removed")
              .when(~F.col("_now").eqNullSafe(F.col("_last")), "changed"))
    return a.join(b, list(keys), "full").select(*keys, change.alias("change")).where(F.col("change").isNotNull())


@dataclass(frozen=True)
class Stage:
    """``run(spark, inputs)`` gives the table to be written to ``output``;
    ``inputs`` are paths by name, ``settings`` whatever else decides the result."""

    name: str
    inputs: Mapping[str, str]
    output: str
    run: Callable[[SparkSession, Mapping[str, str]], DataFrame]
    settings: Mapping[str, object] = field(default_factory=dict)


def in_order(stages: Sequence[Stage]) -> list[Stage]:
    """Each stage after those whose output it reads."""
    made, left, out = {s.output: s for s in stages}, list(stages), []
    if len(made) < len(stages):
        raise ValueError("two stages write the same output")
    if len({s.name for s in stages}) < len(stages):
        raise ValueError("two stages have the same name")
    while left:
        waits = {s.output for s in left}
        ready = [s for s in left if not waits & set(s.inputs.values())]
        if not ready:
            raise ValueError("stages read each other's outputs in a ring: " + ", ".join(s.name for s in left))
        out += ready
        left = [s for s in left if s not in ready]
    return out


def _state(spark: SparkSession, stage: Stage) -> DataFrame:
    settings = json.dumps(dict(stage.settings), sort_keys=True, default=str)
    out = spark.createDataFrame([("settings", stage.name, "", None, settings)], MANIFEST)
    for role, paths in (("input", stage.inputs), ("output", {stage.name: stage.output})):
        for name, path in paths.items():
            out = out.unionByName(manifest(spark, path).select(F.lit(role).alias("role"), F.lit(name).alias("name"), "file", "size_bytes", "md5"))
    return out


def run_stages(spark: SparkSession, stages: Sequence[Stage], state_dir: str) -> dict[str, bool]:
    """Runs what has to be, in order; says of each stage whether it ran. The
    manifests lie in ``state_dir``, one table per stage, written after the
    output: a run that fails in between is repeated."""
    ran = {}
    for stage in in_order(stages):
        path = f"{state_dir.rstrip('/')}/{stage.name}"
        try:
            last = spark.read.schema(MANIFEST).parquet(path)
            ran[stage.name] = not changes(_state(spark, stage), last, ("role", "name", "file")).isEmpty()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            ran[stage.name] = True
        if ran[stage.name]:
            stage.run(spark, stage.inputs).write.mode("overwrite").parquet(stage.output)
            _state(spark, stage).write.mode("overwrite").parquet(path)
    return ran
