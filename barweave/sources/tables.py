"""Tables stored as Parquet folders."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import METRICS, without
from ..sinks import versions
from ..sinks.folders import children, exists


def read_table(
    spark: SparkSession, path: str, schema: StructType, at: int | None = None
) -> DataFrame:
    """The table's current rows, or those of a snapshot (``versions.snapshot``): whatever is
    published meanwhile, a frame keeps the version folders it was made with."""
    if not versions.is_versioned(spark, path):
        return spark.read.schema(schema).parquet(path)
    return _read_versions(spark, path, schema, list(versions.current(spark, path, at).values()))


def _read_versions(
    spark: SparkSession, path: str, schema: StructType, found: list[str]
) -> DataFrame:
    if not found:
        return spark.createDataFrame([], schema)
    root = f"{path}/{versions.VERSIONS}"
    return spark.read.schema(schema).option("basePath", root).parquet(*found)


def partition_folder(
    spark: SparkSession, path: str, day: date, column: str = "as_of_date"
) -> str | None:
    """Where the rows of one date partition are; None if it was never written."""
    name = f"{column}={day.isoformat()}"
    if versions.is_versioned(spark, path):
        return versions.current(spark, path).get(name)
    return f"{path}/{name}" if exists(spark, f"{path}/{name}") else None


def read_partition(
    spark: SparkSession, path: str, schema: StructType, day: date, column: str = "as_of_date"
) -> DataFrame:
    """One date partition, listed alone: its folder is read and no other. A partition that was
    never written has no rows."""
    folder = partition_folder(spark, path, day, column)
    stored = without(schema, column)
    if folder:
        rows = spark.read.schema(stored).parquet(folder)
    else:
        rows = spark.createDataFrame([], stored)
    return rows.withColumn(column, F.lit(day).cast("date")).select(*schema.fieldNames())


def partition_dates(spark: SparkSession, path: str, column: str = "as_of_date") -> list[date]:
    """The table's date partitions, from one listing of names."""
    prefix = f"{column}="
    versioned = versions.is_versioned(spark, path)
    names = versions.current(spark, path) if versioned else children(spark, path)
    found = [name.removeprefix(prefix) for name in names if name.startswith(prefix)]
    return sorted(map(date.fromisoformat, found))


def read_newest_partition(
    spark: SparkSession, path: str, schema: StructType, column: str = "as_of_date"
) -> DataFrame:
    """The partition of the newest date; no other is listed or read."""
    days = partition_dates(spark, path, column)
    if not days:
        raise ValueError(f"{path} has no partition")
    return read_partition(spark, path, schema, days[-1], column)


def read_partitions(
    spark: SparkSession,
    path: str,
    schema: StructType,
    first: date,
    last: date,
    column: str = "as_of_date",
) -> DataFrame:
    """The partitions from ``first`` to ``last``; no other is listed or read."""
    days = [day for day in partition_dates(spark, path, column) if first <= day <= last]
    if not days:
        return spark.createDataFrame([], schema)
    names = [f"{column}={day.isoformat()}" for day in days]
    if versions.is_versioned(spark, path):
        found = versions.current(spark, path)
        return _read_versions(spark, path, schema, [found[name] for name in names])
    paths = [f"{path}/{name}" for name in names]
    return spark.read.schema(schema).option("basePath", path).parquet(*paths)


def newest_date(
    spark: SparkSession, path: str, schema: StructType, column: str, partition: str = "as_of_date"
) -> date | None:
    """The newest value of a date column, None without any. It is the newest partition's name where
    the table is partitioned by it, and no file is opened; else partitions must ascend with the
    column (months of days), and only the newest that has a value is scanned, one column of it."""
    days = partition_dates(spark, path, partition)
    if column == partition:
        return days[-1] if days else None
    for day in reversed(days):
        rows = read_partition(spark, path, schema, day, partition)
        found = rows.agg(F.max(column)).first()[0]
        if found is not None:
            return found
    return None


def read_bucketed_partition(
    spark: SparkSession,
    path: str,
    schema: StructType,
    day: date,
    buckets: int,
    column: str = "as_of_date",
    key: str = "ticker",
) -> DataFrame:
    """One date partition written by ``stage_partition(buckets=...)``, with its bucketing.

    Bucketing lives in the catalog, not in the files, so the partition's folder is declared as
    an external table for as long as it takes to resolve the frame. Joins and aggregates by
    ``key`` then need no shuffle of this side.
    """
    name = f"bucketed_{uuid.uuid4().hex}"
    folder = partition_folder(spark, path, day, column)
    if folder is None:
        raise ValueError(f"{path} has no partition of {day}")
    spark.sql(
        f"CREATE TABLE {name} ({without(schema, column).toDDL()}) USING parquet "
        f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{folder}'"
    )
    rows = spark.table(name)
    # The frame keeps its resolved relation; dropping an external table leaves the files.
    spark.sql(f"DROP TABLE {name}")
    return rows.withColumn(column, F.lit(day).cast("date"))


def reference_columns(current: DataFrame) -> DataFrame:
    """The four columns an intraday update reads; Parquet skips the other nine."""
    return current.select("ticker", *METRICS)
