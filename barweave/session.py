"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benches. A cluster brings its own settings; no result depends
    on the ones below."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("barweave")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Do not record the Python call site of every column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="barweave-warehouse-"))
        .getOrCreate()
    )


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder under the cluster's shared ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder; on a cluster
    a machine-local folder would be lost with its machine, so there the setting is required.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="barweave-")
        context.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
