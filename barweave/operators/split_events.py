"""Split events by identity: what the feed says of each, however often its pages are landed.

A claim is one event of the feed: its id there, or without one its ticker, date and ratio. What a
claim says (ticker, date, ratio, or that it is withdrawn) is one version of it, and the version
that was first said last holds: so a page that is landed again, under any name and in any order,
changes nothing, and a correction replaces what it corrects. A file that is written anew takes back
what it no longer says, if no later file has said it. Claims that hold and say the same are one
event.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import SPLITS, without
from ..sources.json_feeds import split_results

SAID = without(SPLITS, "as_of_date").fieldNames()
VERSION = ["claim", *SAID, "withdrawn"]


def _claim() -> Column:
    # Written as JSON, a missing value differs from every other.
    return F.coalesce("id", F.to_json(F.struct("ticker", "execution_date", "split_from", "split_to")))


def _arrival(day: Column, modified: Column, path: Column, place: Column) -> Column:
    return F.struct(
        day.cast("date").alias("day"),
        modified.alias("modified"),
        path.alias("path"),
        place.cast("bigint").alias("place"),
    )


def split_events(pages: DataFrame, day: date) -> DataFrame:
    """(claim, SAID, withdrawn, seen, told) of every result of the pages, read on ``day``."""
    results = pages.select(
        "file", "document", F.posexplode(split_results()).alias("place", "result")
    )
    place = F.shiftleft(F.col("document").cast("bigint"), 32) + F.col("place")
    seen = _arrival(
        F.lit(day), F.col("file.file_modification_time"), F.col("file.file_path"), place
    )
    return results.select("result.*", seen.alias("seen")).select(
        _claim().alias("claim"),
        *SAID,
        F.coalesce("withdrawn", F.lit(False)).alias("withdrawn"),
        "seen",
        F.col("seen").alias("told"),
    )


def known_events(splits: DataFrame, day: date) -> DataFrame:
    """Splits that are known without a feed, as events seen on ``day`` before all others."""
    seen = _arrival(
        F.lit(day), F.lit(0).cast("timestamp"), F.lit(""), F.lit(0)
    )
    return splits.withColumn("id", F.lit(None).cast("string")).select(
        _claim().alias("claim"),
        *SAID,
        F.lit(False).alias("withdrawn"),
        seen.alias("seen"),
        seen.alias("told"),
    )


def merge_events(ledger: DataFrame, events: DataFrame, files: DataFrame, day: date) -> DataFrame:
    """The ledger after the ``events`` of newly read ``files`` (path, modified): one row for each
    version of a claim, with when it was first and last said."""
    rewritten = files.select(F.col("path").alias("told_in"), "modified")
    said = events.filter(~F.col("withdrawn")).select(
        F.struct("claim", *SAID).alias("version"), F.col("told.path").alias("said_in")
    )
    gone = (
        ledger.filter(~F.col("withdrawn"))
        .join(rewritten, F.col("told.path") == F.col("told_in"))
        .join(
            said,
            F.struct("claim", *SAID).eqNullSafe(F.col("version"))
            & (F.col("told_in") == F.col("said_in")),
            "left_anti",
        )
    )
    # Before the file's own places: what it says instead holds.
    seen = _arrival(F.lit(day), F.col("modified"), F.col("told_in"), F.lit(-1))
    gone = gone.select(
        "claim", *SAID, F.lit(True).alias("withdrawn"), seen.alias("seen"), seen.alias("told")
    )
    rows = ledger.select(*VERSION, "seen", "told").unionByName(events).unionByName(gone)
    return rows.groupBy(*VERSION).agg(F.min("seen").alias("seen"), F.max("told").alias("told"))


def active_splits(ledger: DataFrame) -> DataFrame:
    """(SAID) of the splits that hold, each once."""
    last = F.max(F.struct("seen", "withdrawn", *SAID)).alias("last")
    return (
        ledger.groupBy("claim")
        .agg(last)
        .filter(~F.col("last.withdrawn"))
        .select(*[f"last.{name}" for name in SAID])
        .distinct()
    )


def _per_day(splits: DataFrame, prefix: str) -> DataFrame:
    return splits.groupBy("ticker", "execution_date").agg(
        F.product("split_from").alias(f"{prefix}_from"), F.product("split_to").alias(f"{prefix}_to")
    )


def changed_ratios(before: DataFrame, after: DataFrame) -> DataFrame:
    """(SAID): what turns history that ``before`` was applied to into history under ``after``, one
    row per ticker and date: a new split's ratio, a withdrawn one's inverse, a correction's
    quotient. Nothing for a day whose ratio stays."""
    keys = ["ticker", "execution_date"]
    both = _per_day(before, "old").join(_per_day(after, "new"), keys, "full_outer")
    one = F.lit(1.0)
    changed = both.select(
        "execution_date",
        (F.coalesce("new_from", one) * F.coalesce("old_to", one)).alias("split_from"),
        (F.coalesce("new_to", one) * F.coalesce("old_from", one)).alias("split_to"),
        "ticker",
    )
    # The same factors in another order may differ in their last bits.
    differs = F.abs(F.col("split_from") - F.col("split_to")) > 1e-9 * F.col("split_to")
    return changed.filter(F.coalesce(differs, F.lit(True)))
