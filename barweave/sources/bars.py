"""Daily bar files: gzip CSV with a header, one path per day."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import epoch_nanos_to_date
from ..schemas import BAR_CSV, BARS

# Strftime layouts below the feed's root folder.
DAY_LAYOUT = "%Y/%m/%Y-%m-%d.csv.gz"
MONTH_LAYOUT = "%Y/%m"


def is_trading_day(day: date) -> bool:
    """Monday to Friday; market holidays are not modelled."""
    return day.weekday() < 5


def _read(spark: SparkSession, paths: list[str]) -> DataFrame:
    # enforceSchema=False checks the header names, so a reordered file fails instead of
    # filling the wrong columns.
    raw = (
        spark.read.schema(BAR_CSV)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("recursiveFileLookup", True)
        .csv(paths)
    )
    return raw.withColumn("snapshot_date", epoch_nanos_to_date(F.col("window_start")))


def read_daily_bars(
    spark: SparkSession, root: str, day: date, layout: str = DAY_LAYOUT
) -> DataFrame:
    """One day's bars; on a weekend an empty frame, never the day before's rows."""
    if not is_trading_day(day):
        return spark.createDataFrame([], BARS)
    return _read(spark, [f"{root}/{day.strftime(layout)}"])


def months_between(first: date, last: date) -> list[date]:
    """First days of the months from ``first`` to ``last``, both included."""
    count = (last.year - first.year) * 12 + last.month - first.month + 1
    start = first.year * 12 + first.month - 1
    return [date((start + i) // 12, (start + i) % 12 + 1, 1) for i in range(count)]


def read_month_bars(
    spark: SparkSession, root: str, months: Iterable[date], layout: str = MONTH_LAYOUT
) -> DataFrame:
    """Whole months of bars in one read, so all files are scanned in parallel."""
    return _read(spark, [f"{root}/{month.strftime(layout)}" for month in months])
