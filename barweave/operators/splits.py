"""Stock splits: ranking, cumulative factors, and as-of matching to bars.

A bar is restated by the product of every later split, rounded after each step from the
newest split to the oldest. That order makes the fold sequential per ticker, so identical
split rows are first counted (a map-side combine); what is left per ticker is bounded by its
distinct split dates and ratios, not by the number of rows of the feed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.arrays import PRICE_FIELDS
from ..functions.prices import ADJUSTED_DIGITS, adjust_price, adjust_volume

_ENTRY = (
    "struct<execution_date: date, split_from: double, split_to: double, as_of_date: date, "
    "copies: bigint, rank_before: bigint, from_before: double, to_before: double, "
    "from_factor: double, to_factor: double>"
)


def _distinct_splits(splits: DataFrame) -> DataFrame:
    return splits.groupBy(
        "ticker",
        F.to_date("execution_date").alias("execution_date"),
        "split_from",
        "split_to",
        "as_of_date",
    ).agg(F.count("*").alias("copies"))


def rank_splits(splits: DataFrame) -> DataFrame:
    """Number each ticker's splits, newest first."""
    order = W.partitionBy("ticker").orderBy(
        F.desc("execution_date"), F.desc("split_from"), F.desc("split_to"), F.desc("as_of_date")
    )
    through = F.sum("copies").over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    return (
        _distinct_splits(splits)
        .withColumn("through", through)
        .withColumn(
            "row_number",
            F.explode(F.sequence(F.col("through") - F.col("copies") + 1, F.col("through"))),
        )
        .select("ticker", "execution_date", "split_from", "split_to", "as_of_date", "row_number")
    )


def _multiply(start: Column, ratio: Column, rank_before: Column, times: Column) -> Column:
    """Multiply ``times`` times, rounding each product; the newest ratio is taken as it is."""
    return F.aggregate(
        F.sequence(rank_before + 1, rank_before + times),
        start,
        lambda factor, rank: F.when(rank == 1, ratio).otherwise(
            F.round(factor * ratio, ADJUSTED_DIGITS)
        ),
    )


def _fold(state: Column, split: Column) -> Column:
    """Append one split, with the factors before and after it, to the running state."""
    steps = (state["rank"], split["copies"])
    from_factor = _multiply(state["from_factor"], split["split_from"], *steps)
    to_factor = _multiply(state["to_factor"], split["split_to"], *steps)
    entry = F.struct(
        split["execution_date"].alias("execution_date"),
        split["split_from"].alias("split_from"),
        split["split_to"].alias("split_to"),
        split["as_of_date"].alias("as_of_date"),
        split["copies"].alias("copies"),
        state["rank"].alias("rank_before"),
        state["from_factor"].alias("from_before"),
        state["to_factor"].alias("to_before"),
        from_factor.alias("from_factor"),
        to_factor.alias("to_factor"),
    )
    return F.struct(
        (state["rank"] + split["copies"]).alias("rank"),
        from_factor.alias("from_factor"),
        to_factor.alias("to_factor"),
        F.concat(state["entries"], F.array(entry)).alias("entries"),
    )


def split_history(splits: DataFrame) -> DataFrame:
    """One row per ticker: its splits newest first, each with its cumulative factors."""
    start = F.struct(
        F.lit(0).cast("bigint").alias("rank"),
        F.lit(1.0).alias("from_factor"),
        F.lit(1.0).alias("to_factor"),
        F.array().cast(f"array<{_ENTRY}>").alias("entries"),
    )
    # Grouped by a struct, the result is not yet partitioned by ticker. A join by ticker then
    # shuffles this small side once more, directly below the join: only a join shuffled on both
    # sides lets adaptive execution split up a ticker that holds much of the other side.
    collected = (
        _distinct_splits(splits)
        .groupBy(F.struct("ticker").alias("key"))
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct("execution_date", "split_from", "split_to", "as_of_date", "copies")
                ),
                asc=False,
            ).alias("rows")
        )
    )
    return collected.select(
        "key.ticker", F.aggregate("rows", start, _fold, lambda s: s["entries"]).alias("history")
    )


def cumulative_factors(splits: DataFrame) -> DataFrame:
    """One row per split: its rank and the factor of it and every newer split together."""
    entry = split_history(splits).select("ticker", F.explode("history").alias("s"))
    copy = entry.select(
        "ticker",
        "s",
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("s.copies"))).alias("copy"),
    )
    steps = (F.col("s.rank_before"), F.col("copy"))
    return copy.select(
        "ticker",
        "s.execution_date",
        _multiply(F.col("s.from_before"), F.col("s.split_from"), *steps).alias("split_from"),
        _multiply(F.col("s.to_before"), F.col("s.split_to"), *steps).alias("split_to"),
        "s.as_of_date",
        (F.col("s.rank_before") + F.col("copy")).alias("row_number"),
    )


def factor_as_of(history: Column, day: Column) -> Column:
    """The entry that restates a bar of ``day``: the oldest split after it, or NULL.

    Splits after ``day`` are a prefix of the newest-first array, so the oldest is the last one
    kept; among equal dates that is the one with the largest rank.
    """
    later = F.filter(history, lambda split: split["execution_date"] > day)
    return F.try_element_at(later, F.lit(-1))


def match_factors(bars: DataFrame, splits: DataFrame) -> DataFrame:
    """As-of join at the grain of flat bars: adds ``split_from`` and ``split_to`` (NULL = none).

    The right side has one row per ticker, so a bar never multiplies. There is no broadcast
    hint: Spark broadcasts a history it has measured to be small, and otherwise sort-merges,
    where adaptive execution splits a ticker that holds much of the bars.
    """
    return (
        bars.join(split_history(splits), "ticker", "left")
        .withColumn("split", factor_as_of(F.col("history"), F.col("snapshot_date")))
        .withColumn("split_from", F.col("split.from_factor"))
        .withColumn("split_to", F.col("split.to_factor"))
        .drop("history", "split")
    )


def adjust_bars(bars: DataFrame, splits: DataFrame) -> DataFrame:
    """Flat bars restated for every later split."""
    ratio = (F.col("split_from"), F.col("split_to"))
    return match_factors(bars, splits).select(
        "ticker",
        adjust_volume(F.col("volume"), *ratio).alias("volume"),
        *[adjust_price(F.col(name), *ratio).alias(name) for name in PRICE_FIELDS],
        "transactions",
        "snapshot_date",
    )


def combined_ratio(splits: DataFrame) -> DataFrame:
    """One ratio per ticker: same-day splits multiply instead of duplicating every bar."""
    return splits.groupBy("ticker").agg(
        F.product("split_from").alias("split_from"), F.product("split_to").alias("split_to")
    )
