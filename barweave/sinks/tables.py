"""Table writes: replace, dynamic partition overwrite, and stage -> check -> publish."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.checks import refuse_failed, run_checks
from ..schemas import without
from . import folders, versions


def conform(frame: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types; a missing column is an error."""
    have = {field.name: field.dataType.simpleString() for field in frame.schema}
    # Casting an array to its own type still rebuilds every element, so equal types are left.
    return frame.select(
        *[
            F.col(field.name)
            if have.get(field.name) == field.dataType.simpleString()
            else F.col(field.name).cast(field.dataType).alias(field.name)
            for field in schema
        ]
    )


def create_if_absent(
    spark: SparkSession,
    name: str,
    schema: StructType,
    path: str,
    partition_by: Sequence[str] = (),
) -> None:
    partitioning = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({schema.toDDL()}) USING parquet {partitioning} "
        f"LOCATION '{path}'"
    )


class _Measured:
    """Checks (boolean aggregates) that are measured while rows are written: no second read.

    The rows are watched behind the write's last shuffle. Of a shuffle without rows adaptive
    execution drops all that lies before it, and a measure taken there would have no answer.
    """

    def __init__(self, checks: Sequence[Column]):
        self.checks = checks
        self.seen = Observation() if checks else None

    def watch(self, rows: DataFrame) -> DataFrame:
        return rows.observe(self.seen, *self.checks) if self.checks else rows

    def refuse_failed(self) -> None:
        """After the write. A check without an answer has failed."""
        if self.seen:
            refuse_failed(name for name, passed in self.seen.get.items() if passed is not True)


def replace_table(
    frame: DataFrame,
    path: str,
    schema: StructType,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    measured: Sequence[Column] = (),
) -> None:
    """Replace the whole table, also by an empty one; then raise if a ``measured`` check failed."""
    seen = _Measured(measured)
    _writer(frame, schema, partition_by, sort_by, seen.watch).mode("overwrite").parquet(path)
    seen.refuse_failed()


def overwrite_partitions(
    frame: DataFrame,
    path: str,
    schema: StructType,
    partition_by: Sequence[str],
    sort_by: Sequence[str] = (),
) -> None:
    """Replace only the partitions present in ``frame``; an empty frame replaces none."""
    _writer(frame, schema, partition_by, sort_by).mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).parquet(path)


def _writer(frame, schema, partition_by, sort_by, watch=lambda rows: rows):
    rows = conform(frame, schema)
    if partition_by:
        # AQE may split a partition value that is too large for one task, and merges small ones.
        rows = rows.hint("rebalance", *partition_by)
    rows = watch(rows)
    if sort_by:
        rows = rows.sortWithinPartitions(*partition_by, *sort_by)
    return rows.write.partitionBy(*partition_by) if partition_by else rows.write


def stage_partition(
    frame: DataFrame,
    table: str,
    schema: StructType,
    day: date,
    column: str = "as_of_date",
    sort_by: Sequence[str] = (),
    buckets: int | None = None,
    key: str = "ticker",
) -> str:
    """Write one partition's rows as a new version that is not yet current; returns its folder.

    ``column`` is left to the folder name. With ``buckets`` the files are bucketed and sorted by
    ``key``, so the next day's join does not shuffle them. The rows must then already be
    partitioned by ``key`` into that many partitions, as a join over a table of the same
    bucketing leaves them: then every task writes one file, and writing shuffles nothing either.
    """
    folder = versions.new_version(table, f"{column}={day.isoformat()}")
    rows = conform(frame, schema).drop(column)
    if buckets:
        name = f"staged_{uuid.uuid4().hex}"
        (
            rows.write.bucketBy(buckets, key)
            .sortBy(key)
            .option("path", folder)
            .saveAsTable(name)
        )
        # Only the catalog entry goes; the files of a table with a path stay.
        frame.sparkSession.sql(f"DROP TABLE {name}")
    else:
        if sort_by:
            rows = rows.sortWithinPartitions(*sort_by)
        rows.write.parquet(folder)
    return folder


def read_staged(
    spark: SparkSession, folder: str, schema: StructType, day: date, column: str = "as_of_date"
) -> DataFrame:
    rows = spark.read.schema(without(schema, column)).parquet(folder)
    return conform(rows.withColumn(column, F.lit(day).cast("date")), schema)


def publish_partition(
    frame: DataFrame,
    table: str,
    schema: StructType,
    day: date,
    checks: Callable[[DataFrame], Sequence[DataFrame]] | None = None,
    column: str = "as_of_date",
    sort_by: Sequence[str] = (),
    buckets: int | None = None,
    keep_for: timedelta = timedelta(hours=1),
    measured: Sequence[Column] = (),
) -> None:
    """Replace the partition of ``day`` by the rows of ``frame`` once all checks pass.

    The rows are computed and written once, as a version of their own. The ``measured`` checks,
    boolean aggregates of the rows, are taken while writing; ``checks`` read the version. One
    entry in the table's log makes it current. Until then, and after any failure, readers find the
    version before. Replaced versions stay for ``keep_for``, for those still reading them. An empty
    frame empties the partition.
    """
    spark = frame.sparkSession
    seen = _Measured(measured)
    rows = seen.watch(conform(frame, schema))
    staged = stage_partition(rows, table, schema, day, column, sort_by, buckets)
    try:
        seen.refuse_failed()
        if checks:
            run_checks(*checks(read_staged(spark, staged, schema, day, column)))
    except Exception:
        folders.delete(spark, staged)
        raise
    versions.switch(spark, table, staged)
    versions.forget(spark, table, f"{column}={day.isoformat()}", keep_for)
