"""Apply a batch of quotes to the current-day table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.quotes import last_quote, latest_quote, metric_values, price_updates
from ..schemas import METRICS, QUOTE_ARRIVAL


def apply_quotes(
    current: DataFrame, quotes: DataFrame, last_write_wins: bool = False
) -> DataFrame:
    """The table after the newest valid quote of each ticker, in one join.

    Unknown tickers are dropped, rows without a quote keep their values, and a matched row is
    overwritten whole, NULLs included. A quote older than the stored one is ignored; of equal times
    the higher price stays, as within a batch.

    With ``last_write_wins`` the quote that arrived last is applied instead, whatever its time. The
    quotes then bring their ``arrival`` (``read_quotes(arrival=True)``), and so does the result,
    which must be kept for the next batch: a quote that arrived before the stored one is ignored.
    Either way the result does not depend on how quotes are cut into batches.
    """
    return _merged(current, quotes, last_write_wins, "left")


def changed_rows(
    current: DataFrame, quotes: DataFrame, last_write_wins: bool = False
) -> DataFrame:
    """Only the rows of ``apply_quotes`` that a quote changes, whole, as they then are. It has as
    many rows as the quotes have tickers, at most, however long the table is."""
    return _merged(current, quotes, last_write_wins, "inner")


def _merged(current: DataFrame, quotes: DataFrame, last_write_wins: bool, how: str) -> DataFrame:
    updates = price_updates(quotes)
    if last_write_wins:
        if "arrival" not in quotes.columns:
            raise ValueError("last_write_wins needs quotes with their arrival")
        if "arrival" not in current.columns:
            unknown = F.lit(None).cast(QUOTE_ARRIVAL)
            current = current.withColumn("arrival", unknown)
        newest = last_quote(updates)
    else:
        newest = latest_quote(updates)
    newest = newest.select(
        "ticker",
        F.col("current_price").alias("new_price"),
        F.col("last_updated_datetime").alias("new_time"),
        F.lit(True).alias("matched"),
        *([F.col("arrival").alias("new_arrival")] if last_write_wins else []),
    )
    # One order decides within a batch, across batches, and against the stored row.
    order = ["arrival"] if last_write_wins else []
    stored = F.struct(*order, "last_updated_datetime", "current_price")
    new = F.struct(*[f"new_{name}" for name in order], "new_time", "new_price")
    first = F.col("arrival" if last_write_wins else "last_updated_datetime").isNull()
    readable = F.lit(True) if last_write_wins else F.col("new_time").isNotNull()
    accepted = F.col("matched") & (first | (readable & (new >= stored)))
    updates = metric_values(F.col("new_price"), {base: F.col(base) for base in METRICS})
    updates["current_price"] = F.col("new_price")
    updates["last_updated_datetime"] = F.col("new_time")
    if last_write_wins:
        updates["arrival"] = F.col("new_arrival")
    rows = current.join(newest, "ticker", how)
    if how == "inner":
        rows = rows.filter(accepted)
    return rows.select(
        *[
            F.when(accepted, updates[name]).otherwise(F.col(name)).alias(name)
            if name in updates
            else F.col(name)
            for name in current.columns
        ]
    )
