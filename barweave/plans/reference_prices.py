"""Per-ticker reference prices, and the current-day table built from them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import last_value, mean
from ..functions.calendar import previous_weekday
from ..functions.market_cap import NOT_PROVIDED
from ..operators.details import latest_details
from ..schemas import CURRENT_DAY

QUARTER_DAYS = 90


def dim_prices(cumulative: DataFrame, day: date, last_close: str = "weekday") -> DataFrame:
    """Last close, 90-day mean and whole-array mean per ticker; no shuffle.

    ``last_close="weekday"`` takes the bar dated the last weekday up to ``day`` (NULL on a
    market holiday); ``"latest"`` takes the newest bar. Fields are extracted before the
    lambdas, so Parquet reads only close and date out of the seven.
    """
    if last_close not in ("weekday", "latest"):
        raise ValueError(f"last_close: {last_close}")
    today = F.lit(day).cast("date")
    closes = F.col("price_array.close")
    dated = F.zip_with(
        closes,
        F.col("price_array.snapshot_date"),
        lambda close, on: F.struct(close.alias("close"), on.alias("on")),
    )

    def closes_where(condition):
        return F.transform(F.filter(dated, condition), lambda bar: bar["close"])

    if last_close == "weekday":
        weekday = previous_weekday(today)
        last = last_value(closes_where(lambda bar: bar["on"] == weekday))
    else:
        last = F.get(closes, 0)
    quarter = F.date_sub(F.col("as_of_date"), QUARTER_DAYS)
    return cumulative.filter(F.col("as_of_date") == today).select(
        "ticker",
        last.alias("close_price_last_day"),
        mean(closes_where(lambda bar: bar["on"] > quarter)).alias("close_price_avg_last_90_days"),
        mean(closes).alias("close_price_avg_last_365_days"),
        "as_of_date",
    )


def init_current_day(prices: DataFrame, details: DataFrame, day: date) -> DataFrame:
    """The day's reference prices with market-cap category and empty intraday columns."""
    caps = latest_details(details).select("ticker", "market_cap_description")
    joined = (
        prices.filter(F.col("as_of_date") == F.lit(day).cast("date"))
        .drop("as_of_date")
        .join(caps, "ticker", "left")
        .withColumn(
            "market_cap_description",
            F.coalesce("market_cap_description", F.lit(NOT_PROVIDED)),
        )
    )
    known = set(joined.columns)
    return joined.select(
        *[
            F.col(field.name)
            if field.name in known
            else F.lit(None).cast(field.dataType).alias(field.name)
            for field in CURRENT_DAY
        ]
    )
