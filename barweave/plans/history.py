"""The rolling year: built once from flat bars, then advanced a day at a time."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import adjust_bar, bar_row, keep_after, newest_first, prepend
from ..operators.bars import max_date, one_bar_per_day, valid_bars
from ..operators.splits import combined_ratio, factor_as_of, split_history
from ..schemas import WINDOW_DAYS


def _window_start(as_of: Column, days: int = WINDOW_DAYS) -> Column:
    return F.date_sub(as_of, days)


def backfill_cumulative(
    bars: DataFrame, splits: DataFrame, as_of: date | None = None, valid_only: bool = False
) -> DataFrame:
    """One split-adjusted year of bars per ticker, as of the newest bar (or of ``as_of``).

    Adjustment runs inside the finished arrays: the join with the split histories then has one
    row per ticker on both sides and reuses the array aggregate's partitioning, instead of
    matching every bar. Bars outside the window all map to the day NULL and combine to one row
    per ticker before the shuffle; they only keep their ticker present, with a NULL array. Splits
    executed after ``as_of`` are left to their own day's step.
    """
    if valid_only:
        bars = valid_bars(bars)
    if as_of is not None:
        newest = F.lit(as_of).cast("date")
        bars = bars.filter(F.col("snapshot_date") <= newest)
        splits = splits.filter(F.to_date("execution_date") <= newest)
    else:
        newest = max_date(bars, "snapshot_date")
    in_window = F.col("snapshot_date") > _window_start(newest)
    days = one_bar_per_day(bars, F.when(in_window, F.col("snapshot_date")))
    kept = F.when(F.col("snapshot_date").isNotNull(), bar_row())
    arrays = days.groupBy("ticker").agg(F.collect_list(kept).alias("rows"))

    def matched(bar: Column) -> Column:
        split = factor_as_of(F.col("history"), bar["snapshot_date"])
        return F.struct(bar.alias("bar"), split.alias("split"))

    def adjusted(pair: Column) -> Column:
        split = pair["split"]
        return adjust_bar(pair["bar"], split["from_factor"], split["to_factor"])

    # Two passes, so that the split of a bar is looked up once and not once per price.
    array = F.transform(F.transform(F.sort_array("rows", asc=False), matched), adjusted)
    return arrays.join(split_history(splits), "ticker", "left").select(
        "ticker",
        F.when(F.size("rows") > 0, array).alias("price_array"),
        newest.alias("as_of_date"),
    )


def previous_arrays(cumulative: DataFrame, day: date) -> DataFrame:
    """Yesterday's partition, trimmed to make room for ``day``."""
    yesterday = F.lit(day - timedelta(days=1)).cast("date")
    # One day short of the window: the new day completes it.
    cutoff = _window_start(F.col("as_of_date"), WINDOW_DAYS - 1)
    return cumulative.filter(F.col("as_of_date") == yesterday).withColumn(
        "price_array", keep_after(F.col("price_array"), cutoff)
    )


def _day_ratios(splits: DataFrame, day: date) -> DataFrame:
    return combined_ratio(splits.filter(F.col("as_of_date") == F.lit(day).cast("date")))


def _restated(array: Column) -> Column:
    return F.transform(
        array, lambda bar: adjust_bar(bar, F.col("split_from"), F.col("split_to"))
    )


def split_tickers(cumulative: DataFrame, splits: DataFrame, day: date) -> DataFrame:
    """Yesterday's arrays of the tickers that split on ``day``, restated in place."""
    return (
        previous_arrays(cumulative, day)
        .join(_day_ratios(splits, day), "ticker")
        .select("ticker", _restated(F.col("price_array")).alias("price_array"), "as_of_date")
    )


def unsplit_tickers(cumulative: DataFrame, splits: DataFrame, day: date) -> DataFrame:
    """Yesterday's arrays of every other ticker."""
    return previous_arrays(cumulative, day).join(
        _day_ratios(splits, day).select("ticker"), "ticker", "left_anti"
    )


def daily_step(
    cumulative: DataFrame,
    bars: DataFrame,
    splits: DataFrame,
    day: date,
    valid_only: bool = True,
) -> DataFrame:
    """Advance the arrays to ``day``: trim, restate for the day's splits, prepend its bars.

    One left join covers both the tickers that split and those that did not, so the arrays are
    read once and never exploded. Every join has one row per ticker on each side; over a table
    bucketed by ticker the arrays are not shuffled at all.
    """
    today = F.lit(day).cast("date")
    older = (
        previous_arrays(cumulative, day)
        .join(_day_ratios(splits, day).withColumn("did_split", F.lit(True)), "ticker", "left")
        .select(
            "ticker",
            F.when(F.col("did_split"), _restated(F.col("price_array")))
            .otherwise(F.col("price_array"))
            .alias("older"),
        )
    )
    day_bars = bars.filter(F.col("snapshot_date") == today)
    if valid_only:
        day_bars = valid_bars(day_bars)
    # The greatest of duplicate bars, combined before the shuffle: an array has one element.
    greatest = day_bars.groupBy("ticker").agg(F.max(bar_row()).alias("bar"))
    newer = greatest.select("ticker", newest_first(F.array("bar")).alias("newer"))
    return older.join(newer, "ticker", "full_outer").select(
        "ticker",
        prepend(F.col("newer"), F.col("older")).alias("price_array"),
        today.alias("as_of_date"),
    )


def _per_day(splits: DataFrame) -> DataFrame:
    return splits.groupBy("ticker", "execution_date").agg(
        F.product("split_from").alias("split_from"),
        F.product("split_to").alias("split_to"),
        F.max("as_of_date").alias("as_of_date"),
    )


def late_splits(splits: DataFrame, applied: DataFrame) -> DataFrame:
    """What is left to apply of ``splits``, one row per ticker and execution date.

    A split missing from ``applied`` is left as a whole. Where the ratios of a day differ, because
    one was corrected or a second one came, their quotient is left, so that the rows of
    ``applied`` and the new one multiply to the feed's. A split that the feed no longer has stays.
    """
    keys = ["ticker", "execution_date"]
    known = _per_day(applied).select(
        *keys, F.col("split_from").alias("known_from"), F.col("split_to").alias("known_to")
    )
    one = F.lit(1.0)
    left = _per_day(splits).join(known, keys, "left").select(
        "execution_date",
        (F.col("split_from") * F.coalesce("known_to", one)).alias("split_from"),
        (F.col("split_to") * F.coalesce("known_from", one)).alias("split_to"),
        "ticker",
        "as_of_date",
    )
    # The same factors in another order may differ in their last bits. A ratio without a value is
    # left too, so that the checks see it.
    differs = F.abs(F.col("split_from") - F.col("split_to")) > 1e-9 * F.col("split_to")
    return left.filter(F.coalesce(differs, F.lit(True)))


def apply_late_splits(cumulative: DataFrame, splits: DataFrame, applied: DataFrame) -> DataFrame:
    """Restate stored history for splits that arrived after their day was merged.

    Only elements older than a split's execution date change, and only for splits missing from
    ``applied``; record ``late_splits`` there afterwards and a second run changes nothing.
    """
    return restate(cumulative, late_splits(splits, applied))


def restate(cumulative: DataFrame, late: DataFrame) -> DataFrame:
    """Stored history with the rows of ``late_splits`` applied. One left join by ticker, with one
    row per ticker on both sides."""
    per_day = _per_day(late).withColumn("execution_date", F.to_date("execution_date"))
    pending = per_day.groupBy("ticker").agg(
        F.sort_array(
            F.collect_list(F.struct("execution_date", "split_from", "split_to"))
        ).alias("pending")
    )

    def matched(bar: Column) -> Column:
        later = F.filter("pending", lambda s: s["execution_date"] > bar["snapshot_date"])
        ratio = F.aggregate(
            later,
            F.struct(F.lit(1.0).alias("split_from"), F.lit(1.0).alias("split_to")),
            lambda r, s: F.struct(
                (r["split_from"] * s["split_from"]).alias("split_from"),
                (r["split_to"] * s["split_to"]).alias("split_to"),
            ),
        )
        ratio = F.when(F.size(later) > 0, ratio)
        return F.struct(bar.alias("bar"), ratio.alias("ratio"))

    def restated(pair: Column) -> Column:
        bar, ratio = pair["bar"], pair["ratio"]
        adjusted = adjust_bar(bar, ratio["split_from"], ratio["split_to"])
        return F.when(ratio.isNotNull(), adjusted).otherwise(bar)

    return cumulative.join(pending, "ticker", "left").select(
        "ticker",
        F.when(F.col("pending").isNull(), F.col("price_array"))
        .otherwise(F.transform(F.transform("price_array", matched), restated))
        .alias("price_array"),
        "as_of_date",
    )
