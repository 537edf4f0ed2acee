"""Instrument details."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.market_cap import market_cap_bucket
from .bars import max_date


def ticker_details(documents: DataFrame, run_date: date) -> DataFrame:
    """Rename the source fields and add the market-cap category as of ``run_date``."""
    return documents.select(
        "ticker",
        "ticker_root",
        F.col("name").alias("company_name"),
        F.col("active").alias("is_actively_traded"),
        "currency_name",
        F.col("locale").alias("country"),
        F.col("market").alias("asset_type"),
        "market_cap",
        "primary_exchange",
        F.col("sic_description").alias("industry_description"),
        "weighted_shares_outstanding",
        market_cap_bucket(F.col("market_cap")).alias("market_cap_description"),
        F.lit(run_date).cast("date").alias("as_of_date"),
    )


def latest_details(details: DataFrame) -> DataFrame:
    """Rows of the newest snapshot. The scalar subquery becomes a partition filter when the
    table is partitioned by ``as_of_date``."""
    return details.filter(F.col("as_of_date") == max_date(details, "as_of_date"))
