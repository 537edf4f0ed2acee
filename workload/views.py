"""Market data derived from the given tables, as DataFrames. ``views_sql`` holds the same
derivations as SQL."""

from __future__ import annotations

from datetime import date
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DAY = date(2000, 6, 15)  # a Thursday
SUNDAY = date(2000, 6, 18)


@cache
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Like the views below, the lazy frame is built once per session and
    folder (no data is kept), so that its schema is not read by a job on every use."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ticker(key: str):
    return F.concat(F.lit("S"), F.col(key).cast("string"))


@cache
def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier = ticker; one bar per supplier and ship date."""
    order = (F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1_000_000 + F.col("l_partkey")
    day = F.to_date("l_shipdate")
    nanos = F.datediff(day, F.lit("1970-01-01")).cast("bigint") * 86_400_000_000_000
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(_ticker("l_suppkey").alias("ticker"), day.alias("snapshot_date"))
        .agg(
            F.sum(F.col("l_quantity").cast("bigint")).alias("volume"),
            F.min_by("l_extendedprice", order).alias("open"),
            F.max_by("l_extendedprice", order).alias("close"),
            F.max("l_extendedprice").alias("high"),
            F.min("l_extendedprice").alias("low"),
            F.count("*").alias("transactions"),
        )
        .select(
            "ticker", "volume", "open", "close", "high", "low",
            (F.datediff("snapshot_date", F.lit("1970-01-01")).cast("bigint") * 86_400_000_000_000
             + 14_400_000_000_000).alias("window_start"),
            "transactions", "snapshot_date",
        )
    )


@cache
def splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two per ticker, forward and reverse, 1996 to 2000."""
    key, i = F.col("s_suppkey"), F.col("i")
    executed = F.date_add(F.lit("1996-01-01"), F.pmod(key * 211 + i * 577, F.lit(1800)).cast("int"))
    return (
        table(spark, sf_dir, "supplier")
        .select("s_suppkey", F.explode(F.array(F.lit(1), F.lit(2))).alias("i"))
        .select(
            executed.cast("string").alias("execution_date"),
            (1 + F.pmod(key + i, F.lit(2))).cast("double").alias("split_from"),
            (1 + F.pmod(key * 7 + i * 3, F.lit(10))).cast("double").alias("split_to"),
            _ticker("s_suppkey").alias("ticker"),
            F.lit(DAY).alias("as_of_date"),
        )
    )


@cache
def day_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Splits executed on DAY: 10:1 at high account balances, 1:5 at negative ones."""
    balance = F.col("s_acctbal")
    return (
        table(spark, sf_dir, "supplier")
        .filter((balance < 0) | (balance > 5000))
        .select(
            F.lit(DAY.isoformat()).alias("execution_date"),
            F.when(balance < 0, 5.0).otherwise(1.0).alias("split_from"),
            F.when(balance < 0, 1.0).otherwise(10.0).alias("split_to"),
            _ticker("s_suppkey").alias("ticker"),
            F.lit(DAY).alias("as_of_date"),
        )
    )


def market_cap():
    """NULL, NaN, negative values and every category."""
    key, balance = F.col("s_suppkey"), F.col("s_acctbal")
    return (
        F.when(F.pmod(key, F.lit(11)) == 0, F.lit(None).cast("double"))
        .when(F.pmod(key, F.lit(13)) == 0, F.lit(float("nan")))
        .when(F.pmod(key, F.lit(4)) == 0, balance * 100_000)
        .otherwise(balance * 30_000_000)
    )


@cache
def details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots of every ticker."""
    snapshots = F.array(F.lit(date(2000, 6, 1)), F.lit(date(2000, 6, 10)))
    return table(spark, sf_dir, "supplier").select(
        _ticker("s_suppkey").alias("ticker"),
        F.col("s_name").alias("company_name"),
        market_cap().alias("market_cap"),
        F.explode(snapshots).alias("as_of_date"),
    )


@cache
def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intraday quotes; errors are invalid (c = 0) and some tickers are unknown."""
    price = (F.col("value").cast("decimal(12,2)") * 100).cast("double")
    return table(spark, sf_dir, "events").select(
        _ticker("user_id").alias("ticker"),
        F.when(F.col("event_type") == "error", 0.0).otherwise(price).alias("c"),
        F.col("ts").alias("t"),
        "event_id",
    )


@cache
def quote_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes in the feed's form, with the time as text."""
    # Second to microsecond digits; the stored times have no zone and mean UTC.
    text = F.date_format(F.col("t"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return quotes(spark, sf_dir).select("ticker", "c", text.alias("t"), "event_id")
