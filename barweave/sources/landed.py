"""Which files a feed has landed, which of them were read, and whether its pages are complete."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import FEED_FILES, without
from ..sinks import folders


def landed_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, modified, length, name) of every file; only names are listed, no file is opened.
    ``path`` is written as in a row's ``_metadata``, ``name`` as a reader takes it."""
    return spark.read.format("binaryFile").load(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_size").alias("length"),
        F.col("path").alias("name"),
    )


def refuse_empty_files(spark: SparkSession, path: str | list[str]) -> None:
    """A file of no bytes is a page that was lost; Spark lists no such file."""
    for location in [path] if isinstance(path, str) else path:
        empty = folders.empty_file(spark, location)
        if empty:
            raise ValueError(f"an empty page: {empty}")


def new_files(landed: DataFrame, record: DataFrame) -> DataFrame:
    """The landed files that the record lacks; one that was written anew is new again."""
    known = record.select("path", "modified", "length").distinct()
    return landed.join(known, ["path", "modified", "length"], "left_anti")


def page_addresses(pages: DataFrame) -> DataFrame:
    """(path, modified, length, address, wanted) of every page: its own address, and that of the
    page it goes on with.

    A page that says its ``url`` is found by it. Others are numbered by the last number in their
    file's name, and go on with the next number.
    """
    path = F.col("file.file_path")
    number = F.regexp_extract(path, r"(\d+)\D*$", 1)
    chain = F.regexp_replace(path, r"\d+(\D*)$", "#$1")

    def numbered(value):
        return F.concat(chain, F.lit("#"), value.cast("string"))

    counted = F.try_to_number(number, F.lit("9" * 38)).cast("decimal(38,0)")
    goes_on = F.col("next_url").isNotNull()
    return pages.select(
        path.alias("path"),
        F.col("file.file_modification_time").alias("modified"),
        F.col("file.file_size").alias("length"),
        F.coalesce("url", numbered(counted)).alias("address"),
        F.when(goes_on & F.col("url").isNotNull(), F.col("next_url"))
        .when(goes_on, F.coalesce(numbered(counted + 1), F.lit("none")))
        .alias("wanted"),
    )


def feed_record(landed: DataFrame, record: DataFrame, addresses: DataFrame) -> DataFrame:
    """The record after a read: every landed file, with the pages it is known to hold. It is as
    long as the feed has files and pages, whatever the number of days."""
    files = without(FEED_FILES, "as_of_date").fieldNames()
    known = record.select(*files).unionByName(addresses.select(*files)).distinct()
    return landed.select("path", "modified", "length").join(
        known, ["path", "modified", "length"], "left"
    )
