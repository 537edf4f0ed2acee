"""Flat bars and per-ticker price arrays."""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import bar_row, newest_first
from ..schemas import BAR_FIELDS

POSITIVE_FIELDS = ["volume", "open", "close", "high", "low", "transactions"]


def valid_bars(bars: DataFrame) -> DataFrame:
    """Bars whose volume, prices and transaction count are all positive."""
    return bars.filter(reduce(and_, [F.col(name) > 0 for name in POSITIVE_FIELDS]))


def price_arrays(bars: DataFrame, *keys: str) -> DataFrame:
    """One newest-first array per key. The result has one array element per input bar, so a
    group is as long as its bars: with ticker keys, bounded by the calendar once bars are
    unique per ticker and day (``one_bar_per_day`` or the duplicate check)."""
    return (
        bars.groupBy(*keys)
        .agg(F.collect_list(bar_row()).alias("rows"))
        .select(*keys, newest_first(F.col("rows")).alias("price_array"))
    )


def today_arrays(bars: DataFrame) -> DataFrame:
    """Arrays of the new day's valid bars, one per ticker and day."""
    return price_arrays(valid_bars(bars), "ticker", "snapshot_date")


def one_bar_per_day(bars: DataFrame, day: Column) -> DataFrame:
    """One whole bar per ticker and ``day``: the greatest by its fields, so always the same.

    Duplicates combine before the shuffle, wherever they are concentrated.
    """
    values = [name for name in BAR_FIELDS if name != "snapshot_date"]
    greatest = bars.groupBy("ticker", day.alias("snapshot_date")).agg(
        F.max(F.struct(*values)).alias("bar")
    )
    return greatest.select("ticker", "snapshot_date", "bar.*")


def unnest_prices(cumulative: DataFrame) -> DataFrame:
    """One row per array element; a ticker with an empty or missing array yields none."""
    return cumulative.select("ticker", "as_of_date", F.inline("price_array"))


def positioned_prices(cumulative: DataFrame) -> DataFrame:
    """``unnest_prices`` with the 1-based position, keeping tickers without any bar."""
    return cumulative.select(
        "ticker", "as_of_date", F.posexplode_outer("price_array").alias("pos", "bar")
    ).select("ticker", "as_of_date", (F.col("pos") + 1).alias("position"), "bar.*")


def with_max_date(bars: DataFrame, newest: date | None = None) -> DataFrame:
    """Attach the newest bar date as ``as_of_date``, by a scalar subquery, not a join. Where the
    table's partitions tell it (``sources.tables.newest_date``) the bars are read once."""
    known = max_date(bars, "snapshot_date") if newest is None else F.lit(newest).cast("date")
    return bars.withColumn("as_of_date", known)


def max_date(table: DataFrame, column: str) -> Column:
    return table.agg(F.max(column)).scalar()
