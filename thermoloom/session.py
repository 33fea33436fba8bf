"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings the engine relies on. Adaptive execution coalesces the many small
#: post-aggregation partitions, splits skewed join partitions and picks a
#: broadcast only from sizes it has measured.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Capturing the Python call site of every column costs more than building it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "thermoloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with :data:`SETTINGS`; ``conf`` keys use ``__`` for a dot."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under the cluster's ``spark.checkpoint.dir``.

    Tables that cut lineage and stream checkpoints go there, because every
    executor can reach it. Only a local session without that setting falls back
    to a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.conf.get("spark.master", "").split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="thermoloom-")
    return f"{root.rstrip('/')}/thermoloom/{name}-{uuid.uuid4().hex}"
