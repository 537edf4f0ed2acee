"""Written intermediate results in the folder that all executors share."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession

from barweave.session import work_dir


def checkpointed(df: DataFrame) -> DataFrame:
    """The frame, computed now and written to the shared checkpoint folder: its lineage is cut and
    a lost executor costs nothing that was done before."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(work_dir(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def release(spark: SparkSession) -> None:
    """Shuffle files and checkpoints that no frame refers to any more are removed now. Spark does so
    only after the driver has collected its garbage, which may be long after the next ones are
    written."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
