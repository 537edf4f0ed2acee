"""Data-quality checks: one-row DataFrames with one boolean column per check."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

GROWTH_LIMIT = 1.01

BAR_COLUMNS = [
    "ticker", "volume", "open", "close", "high", "low", "transactions", "snapshot_date",
]
SPLIT_COLUMNS = ["execution_date", "split_from", "split_to", "ticker"]


class DataQualityError(Exception):
    """One or more checks failed; nothing was published."""


def _none(condition):
    return F.count_if(condition) == 0


def none_missing(name: str) -> Column:
    return _none(F.col(name).isNull()).alias(f"{name}_is_not_null_check")


# The checks that one pass over the rows answers are aggregates, so that a write can measure them
# (``sinks.tables``); the functions over a frame ask the same of what is there.


def bar_checks() -> list[Column]:
    """No NULL in any needed column. An empty input passes."""
    return [none_missing(name) for name in BAR_COLUMNS]


def check_bars(bars: DataFrame) -> DataFrame:
    return bars.agg(*bar_checks())


def split_checks() -> list[Column]:
    """No NULL, and ratios above zero."""
    not_null = [none_missing(name) for name in SPLIT_COLUMNS]
    positive = [
        _none(F.col(name) <= 0).alias(f"{name}_is_positive_check")
        for name in ("split_from", "split_to")
    ]
    return [*not_null, *positive]


def check_splits(splits: DataFrame) -> DataFrame:
    return splits.agg(*split_checks())


def check_chains(new: DataFrame, known: DataFrame) -> DataFrame:
    """Every page goes on with a page that is there: of the ``new`` page addresses (address,
    wanted), each wanted one is among them or the ``known`` ones."""
    wanted = new.filter(F.col("wanted").isNotNull()).select("wanted").distinct()
    there = new.select("address").unionByName(known.select("address")).distinct()
    missing = wanted.join(there, F.col("wanted") == F.col("address"), "left_anti")
    return missing.agg((F.count("*") == 0).alias("page_chains_are_whole_check"))


def check_growth(staged: DataFrame, previous: DataFrame) -> DataFrame:
    """Fewer than 1 % more rows than the day before (strictly). One aggregate over a tagged
    union, so neither count is collected."""
    tagged = staged.select(F.lit(True).alias("is_staged")).unionAll(
        previous.select(F.lit(False).alias("is_staged"))
    )
    staged_rows = F.count_if(F.col("is_staged"))
    previous_rows = F.count_if(~F.col("is_staged"))
    return tagged.agg(
        (staged_rows < previous_rows * GROWTH_LIMIT).alias("new_rows_under_threshold_check")
    )


def day_check(day) -> Column:
    """Every bar is dated ``day``; another date would give a ticker two rows in the full join."""
    other = F.col("snapshot_date") != F.lit(day).cast("date")
    return _none(other).alias("snapshot_date_is_day_check")


def check_day(bars: DataFrame, day) -> DataFrame:
    return bars.agg(day_check(day))


def month_check() -> Column:
    """Every bar lies in the month of its partition."""
    other = F.trunc("snapshot_date", "month") != F.col("month")
    return _none(other).alias("snapshot_date_is_in_month_check")


def check_unique(bars: DataFrame) -> DataFrame:
    """No ticker has two bars on a day. Run before arrays are collected, which bounds them."""
    per_day = bars.groupBy("ticker", "snapshot_date").agg(F.count("*").alias("n"))
    return per_day.agg(_none(F.col("n") > 1).alias("bars_are_unique_check"))


def _check_names(checks: DataFrame) -> list[str]:
    return [field.name for field in checks.schema if isinstance(field.dataType, BooleanType)]


def check_report(checks: DataFrame) -> DataFrame:
    """(check_name, passed) rows. A NULL result counts as failed."""
    results = [
        F.struct(F.lit(name).alias("check_name"), F.coalesce(name, F.lit(False)).alias("passed"))
        for name in _check_names(checks)
    ]
    return checks.select(F.inline(F.array(*results)))


def run_checks(*checks: DataFrame) -> None:
    """Raise unless every boolean of every check is true.

    All checks run in one action, and only their booleans reach the driver. A check without a
    row is an error: it has tested nothing.
    """
    reports = [
        check_report(check).withColumn("position", F.lit(position))
        for position, check in enumerate(checks)
    ]
    rows = reduce(DataFrame.unionByName, reports).collect()
    answered = {row["position"] for row in rows}
    if len(answered) < len(checks):
        raise DataQualityError("a check returned no row")
    refuse_failed({row["check_name"] for row in rows if not row["passed"]})


def refuse_failed(names: Iterable[str]) -> None:
    failed = sorted(names)
    if failed:
        raise DataQualityError(", ".join(failed))
