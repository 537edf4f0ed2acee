"""Intraday quotes: validity, newest per ticker, change metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import parse_quote_time
from ..functions.prices import absolute_change, percent_change
from ..schemas import METRICS, METRIC_COLUMNS


def tradable_symbols(assets: DataFrame) -> DataFrame:
    """Symbols without a slash; a slash marks a currency pair."""
    return assets.filter(~F.col("symbol").contains("/"))


def valid_quotes(quotes: DataFrame) -> DataFrame:
    return quotes.filter(F.col("c") > 0)


def price_updates(quotes: DataFrame) -> DataFrame:
    """Feed fields (ticker, c, t) -> (ticker, current_price, last_updated_datetime), and the
    ``arrival`` where the quotes have it."""
    return valid_quotes(quotes).select(
        "ticker",
        F.col("c").alias("current_price"),
        parse_quote_time(F.col("t")).alias("last_updated_datetime"),
        *[name for name in quotes.columns if name == "arrival"],
    )


def latest_quote(updates: DataFrame, *tie_breakers: str) -> DataFrame:
    """Newest update per ticker. Combined map-side, so a busy ticker costs one row per task.

    Equal times are decided by ``tie_breakers``, then by the higher price. An update without a
    readable time sorts before every other.
    """
    names = ["last_updated_datetime", *tie_breakers, "current_price"]
    newest = updates.groupBy("ticker").agg(F.max(F.struct(*names)).alias("newest"))
    return newest.select("ticker", "newest.current_price", "newest.last_updated_datetime")


def last_quote(updates: DataFrame) -> DataFrame:
    """The update of each ticker that arrived last, with its ``arrival``. Of those that arrived
    together the newest, then the higher price: one order, however updates are cut into batches.
    An update without an arrival comes before all others."""
    names = ["arrival", "last_updated_datetime", "current_price"]
    last = updates.groupBy("ticker").agg(F.max(F.struct(*names)).alias("last"))
    return last.select("ticker", *[f"last.{name}" for name in names])


def metric_values(current: Column, bases: dict[str, Column]) -> dict[str, Column]:
    values = {}
    for base, (absolute, percent) in METRICS.items():
        values[absolute] = absolute_change(current, bases[base])
        values[percent] = percent_change(current, bases[base])
    return values


def quote_metrics(updates: DataFrame, reference: DataFrame) -> DataFrame:
    """Metrics of quotes whose ticker has reference prices; other tickers drop out."""
    joined = updates.select("ticker", "current_price", "last_updated_datetime").join(
        reference.select("ticker", *METRICS), "ticker"
    )
    metrics = metric_values(F.col("current_price"), {base: F.col(base) for base in METRICS})
    return joined.withColumns(metrics).select(
        "ticker", "current_price", "last_updated_datetime", *METRIC_COLUMNS
    )
