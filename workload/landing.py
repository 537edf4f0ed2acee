"""Land the derived market data as the files the sources read. Every page is written where its
row is, so landing is as parallel as the input."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barweave.schemas import BAR_CSV
from barweave.sources.bars import DAY_LAYOUT

YEAR_MONTH = "year=%Y/month=%m"


def _csv(frame: DataFrame, *partition_by: str):
    columns = frame.select(*BAR_CSV.fieldNames(), *partition_by)
    writer = columns.write.option("header", True).option("compression", "gzip")
    return writer.partitionBy(*partition_by) if partition_by else writer


def land_days(bars: DataFrame, root: str, days: Iterable[date]) -> None:
    for day in days:
        one = bars.filter(F.col("snapshot_date") == F.lit(day))
        _csv(one).csv(f"{root}/{day.strftime(DAY_LAYOUT)}")


def land_months(bars: DataFrame, root: str) -> None:
    months = bars.withColumns(
        {
            "year": F.date_format("snapshot_date", "yyyy"),
            "month": F.date_format("snapshot_date", "MM"),
        }
    )
    _csv(months.hint("rebalance", "year", "month"), "year", "month").csv(root)


def land_splits(splits: DataFrame, path: str) -> None:
    """One page per split, with whole numbers as the feed sends them. ``id`` and ``withdrawn`` are
    landed where the rows have them."""
    more = [name for name in ("id", "withdrawn") if name in splits.columns]
    result = F.struct(
        "execution_date",
        F.col("split_from").cast("bigint").alias("split_from"),
        F.col("split_to").cast("bigint").alias("split_to"),
        "ticker",
        *more,
    )
    page = F.struct(F.lit("OK").alias("status"), F.array(result).alias("results"))
    splits.select(F.to_json(page)).write.text(path)


def land_split_documents(splits: DataFrame, path: str) -> None:
    """Whole documents on several lines, each with all splits of a date and its address, each but
    the last date's going on with the next."""
    result = F.struct("execution_date", "split_from", "split_to", "ticker")
    pages = splits.groupBy("execution_date").agg(F.sort_array(F.collect_list(result)).alias("results"))
    following = F.lead("execution_date").over(Window.orderBy("execution_date"))
    envelope = F.struct(
        F.lit("OK").alias("status"),
        F.concat(F.lit("splits?date="), "execution_date").alias("url"),
        F.concat(F.lit("splits?date="), following).alias("next_url"),
        F.size("results").alias("count"),
        "results",
    )
    text = F.to_json(envelope, {"pretty": "true"})
    pages.select(text.alias("value")).repartition(4).write.text(path)


def land_documents(documents: DataFrame, path: str) -> None:
    """(status, results) rows; a NULL ``results`` is left out of its document."""
    documents.select(F.to_json(F.struct("status", "results"))).write.text(path)


def land_assets(assets: DataFrame, path: str) -> None:
    assets.select(F.to_json(F.struct("symbol", "status"))).write.text(path)


def land_quotes(quotes: DataFrame, path: str) -> None:
    """One page per quote: a map from ticker to its bar."""
    bar = F.struct(
        "c",
        F.col("c").alias("h"),
        F.col("c").alias("l"),
        F.lit(1).alias("n"),
        F.col("c").alias("o"),
        "t",
        F.lit(100).alias("v"),
        F.col("c").alias("vw"),
    )
    page = F.struct(F.create_map("ticker", bar).alias("bars"))
    quotes.select(F.to_json(page)).write.text(path)
