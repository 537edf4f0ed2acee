"""Dashboard queries over the current-day table."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import METRIC_COLUMNS

TOP_N = 50


def leaderboard(
    current: DataFrame,
    metric: str,
    ascending: bool,
    caps: Iterable[str] | None = None,
    tickers: Iterable[str] | DataFrame | None = None,
    updated: tuple[datetime, datetime] | None = None,
    n: int = TOP_N,
) -> DataFrame:
    """Top ``n`` tickers by ``metric``; ties are broken by ticker.

    ``caps`` and ``tickers`` narrow the rows when given and not empty; ``tickers`` may be
    another board, for a selection made in one chart that filters the others.
    """
    rows = current.filter(F.col(metric).isNotNull())
    if caps:
        rows = rows.filter(F.col("market_cap_description").isin(list(caps)))
    if isinstance(tickers, DataFrame):
        rows = rows.join(tickers.select("ticker"), "ticker", "left_semi")
    elif tickers:
        rows = rows.filter(F.col("ticker").isin(list(tickers)))
    if updated:
        rows = rows.filter(F.col("last_updated_datetime").between(*updated))
    best = rows.groupBy("ticker").agg(F.max(metric).alias(metric))
    order = F.asc(metric) if ascending else F.desc(metric)
    return best.orderBy(order, F.asc("ticker")).limit(n)


def row_count(table: DataFrame) -> DataFrame:
    return table.agg(F.count("*").alias("count"))


def change_by_cap(current: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    """Count, mean, lowest and highest change of each market-cap category.

    Metrics have two decimals, so decimal sums are exact and independent of row order.
    """
    aggregates = [F.count("*").alias("tickers")]
    for name in metrics or METRIC_COLUMNS:
        total = F.sum(F.col(name).cast("decimal(28,2)")).cast("double")
        aggregates += [
            F.count(name).alias(f"{name}_n"),
            F.try_divide(total, F.count(name)).alias(f"{name}_avg"),
            F.min(name).alias(f"{name}_min"),
            F.max(name).alias(f"{name}_max"),
        ]
    return current.groupBy("market_cap_description").agg(*aggregates)
