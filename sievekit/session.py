"""Session construction and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(app: str = "sievekit", master: str | None = None,
              shuffle_partitions: int | None = None, **conf) -> SparkSession:
    """Session with AQE on, UI off, UTC and ANSI semantics.

    On a cluster ``master`` stays ``None`` so the launcher's settings win.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    defaults = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        defaults["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    defaults.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for k, v in defaults.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    The setting is read from the session. Only a local-mode session (tests)
    without it gets a private folder under the system temp dir; a cluster
    session without a shared folder is an error, never a machine-local path.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = tempfile.mkdtemp(prefix="sievekit-")
        spark.conf.set("spark.checkpoint.dir", base)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    base = sc.getCheckpointDir() or base
    sub = f"{name or 'job'}-{uuid.uuid4().hex[:12]}"
    return base.rstrip("/") + "/" + sub     # URI (file:/, hdfs://, s3a://) or plain path
