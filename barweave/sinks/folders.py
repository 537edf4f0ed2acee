"""Files and folders through Hadoop's file system API, so any storage Spark can write to works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, location: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, location: str) -> bool:
    path, files = _path(spark, location)
    return files.exists(path)


def modified(spark: SparkSession, location: str) -> int | None:
    """When it last changed, in milliseconds; None if it does not exist."""
    path, files = _path(spark, location)
    return files.getFileStatus(path).getModificationTime() if files.exists(path) else None


def delete(spark: SparkSession, location: str) -> None:
    path, files = _path(spark, location)
    files.delete(path, True)


def children(spark: SparkSession, location: str) -> list[str]:
    path, files = _path(spark, location)
    if not files.exists(path):
        return []
    return [status.getPath().getName() for status in files.listStatus(path)]


def empty_file(spark: SparkSession, location: str) -> str | None:
    """One of the files at a path or pattern, or in the folders there, that has no bytes."""
    path, files = _path(spark, location)
    for found in files.globStatus(path) or ():
        for status in files.listStatus(found.getPath()) if found.isDirectory() else (found,):
            name = status.getPath().getName()
            if status.isFile() and status.getLen() == 0 and name[0] not in "._":
                return status.getPath().toString()
    return None


def create(spark: SparkSession, location: str) -> None:
    """An empty file; an error if there is one."""
    path, files = _path(spark, location)
    files.mkdirs(path.getParent())
    if not files.createNewFile(path):
        raise FileExistsError(location)
