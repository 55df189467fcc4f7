"""Session helpers: settings the jobs want, and the checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# AQE sizes, coalesces and splits shuffle partitions at run time, so the static
# partition count only has to be high enough for the largest shuffle.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # Candidates are fitted side by side.
    "spark.scheduler.mode": "FAIR",
    # Recording the Python call site of every column costs more than building it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "loanloom", **overrides: str) -> SparkSession:
    """Return a session with the recommended settings; overrides use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    for key, value in overrides.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str | None:
    """Make iterative fits checkpoint into the folder the cluster names.

    The session's ``spark.checkpoint.dir`` wins. ``fallback`` is only for sessions
    that name none, such as tests; on a cluster it must be shared storage.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if folder and spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder in the one ``spark.checkpoint.dir`` names, which all executors share.

    Only a local session that names none, as in tests, gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="loanloom-")
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
