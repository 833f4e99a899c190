"""Session settings and the shared scratch area."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "wavetrawl", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for.

    Partition counts are left to adaptive execution: ``spark.sql.shuffle.partitions`` is only an upper
    start value that AQE coalesces, so it must be raised on a cluster, never lowered per query.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.python.filterPushdown.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Taken from ``spark.checkpoint.dir`` (or an earlier ``setCheckpointDir``). Only a local session may
    fall back to a temporary folder: on a cluster the executors would not see it.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="wavetrawl-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its scheme: one without is on the default file system, as for Spark's own readers."""
    if re.match("[a-zA-Z][a-zA-Z0-9+.-]*:/", path):
        return path
    return f"{default_store(spark)}/{path.lstrip('/')}"


def default_store(spark: SparkSession) -> str:
    """The root of the default file system without its last slash, such as ``file://`` or ``hdfs://name:8020``."""
    root = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
    return "file://" if root.startswith("file:") else root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under :func:`checkpoint_root`."""
    return f"{checkpoint_root(spark).rstrip('/')}/wavetrawl/{label}-{uuid.uuid4().hex}"
