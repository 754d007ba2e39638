"""A session with the settings that the engine expects; a cluster's own settings win."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def session(master: str | None = None, shuffle_partitions: int | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName("terrella")
    if master:
        builder = builder.master(master)
    chosen = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
    }
    if shuffle_partitions:
        chosen["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    return builder.config(map=chosen | {k.replace("__", "."): v for k, v in settings.items()}).getOrCreate()


def scratch(spark: SparkSession) -> str:
    """A new folder that all executors share, below spark.checkpoint.dir; on a local master without one, a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="terrella-")
    return f"{folder.rstrip('/')}/scratch-{uuid.uuid4().hex}"
