"""The daily load: ingest, check, advance the arrays, publish, derive reference prices."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import checks
from ..operators.details import ticker_details
from ..operators.split_events import (
    SAID,
    active_splits,
    changed_ratios,
    known_events,
    merge_events,
    split_events,
)
from ..schemas import (
    BARS,
    BARS_BY_MONTH,
    CUMULATIVE,
    DIM_PRICES,
    FEED_FILES,
    SPLIT_LEDGER,
    SPLITS,
    TICKER_DETAILS,
    WINDOW_DAYS,
)
from ..sinks.tables import overwrite_partitions, publish_partition, read_staged, replace_table
from ..sources.bars import MONTH_LAYOUT, months_between, read_daily_bars, read_month_bars
from ..sources.json_feeds import read_split_pages, read_ticker_documents
from ..sources.landed import (
    feed_record,
    landed_files,
    new_files,
    page_addresses,
    refuse_empty_files,
)
from ..sources.tables import (
    partition_dates,
    partition_folder,
    read_bucketed_partition,
    read_partition,
    read_partitions,
    read_table,
)
from .history import backfill_cumulative, daily_step, restate
from .reference_prices import dim_prices


@dataclass(frozen=True)
class Tables:
    """Folders of the tables below ``root``.

    ``buckets`` buckets the arrays by ticker, the one large table that is joined every day.
    Size it so that a bucket of one day's partition is a few hundred megabytes.
    """

    root: str
    buckets: int | None = None

    @property
    def staged_bars(self) -> str:
        return f"{self.root}/staging_daily_stock_price"

    @property
    def staged_months(self) -> str:
        return f"{self.root}/staging_daily_stock_price_by_month"

    @property
    def splits(self) -> str:
        return f"{self.root}/daily_stock_split"

    @property
    def split_ledger(self) -> str:
        return f"{self.root}/split_ledger"

    @property
    def split_files(self) -> str:
        return f"{self.root}/split_feed_files"

    @property
    def cumulative(self) -> str:
        return f"{self.root}/daily_stock_price_cumulative"

    @property
    def prices(self) -> str:
        return f"{self.root}/dim_daily_stock_price"

    @property
    def details(self) -> str:
        return f"{self.root}/dim_ticker_details"

    @property
    def current(self) -> str:
        return f"{self.root}/current_day_stock_price"

    def arrays_of(self, spark: SparkSession, day: date) -> DataFrame:
        if self.buckets:
            return read_bucketed_partition(spark, self.cumulative, CUMULATIVE, day, self.buckets)
        folder = partition_folder(spark, self.cumulative, day)
        if folder is None:
            raise ValueError(f"no arrays of {day}: start or load that day")
        return read_staged(spark, folder, CUMULATIVE, day)


@dataclass(frozen=True)
class Feeds:
    """Where the day's files land. ``split_lines`` tells JSON lines from one page per file."""

    bars: str
    splits: str
    split_lines: bool = False


def _in_window(day: date):
    """Splits that can still change an array of ``day`` or a later one. One without a readable
    date is kept for the checks to see."""
    first = F.lit(day - timedelta(days=WINDOW_DAYS))
    return F.coalesce(F.col("execution_date").try_cast("date") >= first, F.lit(True))


def start_history(tables: Tables, bars: DataFrame, splits: DataFrame, day: date) -> None:
    """Publish the first partition, which every daily step needs the day before, and record the
    splits as known and no page as read. Splits that are the same by ticker, date and ratio are
    one; those executed after ``day`` wait for their own."""
    spark = splits.sparkSession
    _start_feed(spark, tables, day)
    events = known_events(splits, day).filter(_in_window(day))
    ledger = merge_events(events.limit(0), events, spark.createDataFrame([], FEED_FILES), day)
    publish_partition(_dated(ledger, day), tables.split_ledger, SPLIT_LEDGER, day)
    _start_arrays(tables, bars, splits.select(*SAID).distinct(), day)


def _start_feed(spark: SparkSession, tables: Tables, day: date) -> None:
    """A ledger without a split and a record without a file."""
    for table, schema in ((tables.split_ledger, SPLIT_LEDGER), (tables.split_files, FEED_FILES)):
        publish_partition(spark.createDataFrame([], schema), table, schema, day)


def _start_arrays(tables: Tables, bars: DataFrame, splits: DataFrame, day: date) -> None:
    applied = splits.filter(F.to_date("execution_date") <= F.lit(day))
    publish_partition(_dated(applied, day), tables.splits, SPLITS, day)
    arrays = backfill_cumulative(bars, _dated(splits, day), as_of=day)
    if tables.buckets:
        arrays = arrays.repartition(tables.buckets, "ticker")
    publish_partition(
        arrays,
        tables.cumulative,
        CUMULATIVE,
        day,
        sort_by=["ticker"],
        buckets=tables.buckets,
    )


def stage_months(
    spark: SparkSession,
    tables: Tables,
    root: str,
    months: Iterable[date],
    layout: str = MONTH_LAYOUT,
    again: bool = False,
) -> list[date]:
    """Stage whole months of bar files, one partition a month, and return those staged now.

    A month is published once it is read whole and every bar is checked, so what was interrupted
    goes on with the first month that is missing. ``again`` replaces months that are there.
    """
    done = set() if again else set(partition_dates(spark, tables.staged_months, "month"))
    missing = [month for month in months if month not in done]
    for month in missing:
        bars = read_month_bars(spark, root, [month], layout)
        publish_partition(
            bars.withColumn("month", F.lit(month).cast("date")),
            tables.staged_months,
            BARS_BY_MONTH,
            month,
            column="month",
            sort_by=["ticker", "snapshot_date"],
            measured=[*checks.bar_checks(), checks.month_check()],
        )
    return missing


def staged_bars(spark: SparkSession, tables: Tables, first: date, last: date) -> DataFrame:
    """The staged bars from ``first`` to ``last``; of other months no file is listed or read."""
    rows = read_partitions(
        spark, tables.staged_months, BARS_BY_MONTH, first.replace(day=1), last, "month"
    )
    return rows.drop("month").filter(F.col("snapshot_date").between(first, last))


def start_from_files(
    spark: SparkSession, tables: Tables, feeds: Feeds, day: date, layout: str = MONTH_LAYOUT
) -> None:
    """Build history as of ``day`` from landed files: stage the months of the year that are not
    staged yet, read the feed of splits, publish the first partitions. Only bars inside the year are
    read, so a ticker without any has no row. Run again, it stages nothing twice."""
    first = day - timedelta(days=WINDOW_DAYS - 1)
    stage_months(spark, tables, feeds.bars, months_between(first, day), layout)
    eve = day - timedelta(days=1)
    _start_feed(spark, tables, eve)
    read_new_splits(spark, tables, feeds, day)
    splits = active_splits(_ledger(spark, tables, day)[1])
    _start_arrays(tables, staged_bars(spark, tables, first, day), splits, day)


def _newest(spark: SparkSession, table: str, day: date) -> date | None:
    return max((on for on in partition_dates(spark, table) if on <= day), default=None)


def _ledger(spark: SparkSession, tables: Tables, day: date) -> tuple[date, DataFrame]:
    """The ledger as of a day: a day without new pages has no partition of its own."""
    on = _newest(spark, tables.split_ledger, day)
    if on is None or _newest(spark, tables.split_files, day) is None:
        raise ValueError(f"no record of the splits applied up to {day}: start or load that day")
    return on, read_partition(spark, tables.split_ledger, SPLIT_LEDGER, on)


def _dated(rows: DataFrame, day: date) -> DataFrame:
    return rows.withColumn("as_of_date", F.lit(day).cast("date"))


def read_new_splits(spark: SparkSession, tables: Tables, feeds: Feeds, day: date) -> None:
    """Bring the ledger of splits up to ``day``: the files that no earlier day has read are read,
    and the state of the eve is merged with what they say.

    Only names are listed of the others. A day that is run again starts from its eve again, so it
    reads its own files and those that came since. Nothing is published unless every page has its
    results and every page that goes on has the page it goes on with.
    """
    eve = day - timedelta(days=1)
    _, ledger = _ledger(spark, tables, eve)
    known = _newest(spark, tables.split_files, eve)
    record = read_partition(spark, tables.split_files, FEED_FILES, known)
    if not feeds.split_lines:  # Spark itself lands empty files of JSON lines
        refuse_empty_files(spark, feeds.splits)
    landed = landed_files(spark, feeds.splits)
    fresh = new_files(landed, record)
    names = [row["name"] for row in fresh.select("name").collect()]
    if not names and day not in partition_dates(spark, tables.split_files):
        return
    if names:
        pages = read_split_pages(spark, names, not feeds.split_lines)
        addresses = page_addresses(pages)
        events = split_events(pages, day).filter(_in_window(day))
        stated = events.filter(~F.col("withdrawn"))
        readable = F.col("execution_date").try_cast("date").cast("string")
        checks.run_checks(
            checks.check_chains(addresses, record),
            checks.check_splits(stated.withColumn("execution_date", readable)),
        )
        ledger = merge_events(ledger, events, fresh, day)
        record = feed_record(landed, record, addresses)
    ledger = ledger.filter(_in_window(day)).drop("as_of_date")
    publish_partition(_dated(ledger, day), tables.split_ledger, SPLIT_LEDGER, day)
    # The record comes last: a day that ends before it reads its files again.
    record = record.drop("as_of_date")
    publish_partition(_dated(record, day), tables.split_files, FEED_FILES, day)


def _new_splits(spark: SparkSession, tables: Tables, day: date) -> DataFrame:
    """The splits of ``day``, and what has changed in those executed up to a year before: late
    ones, corrected and withdrawn ones, as the ratio that is left to apply."""
    eve = day - timedelta(days=1)
    if partition_folder(spark, tables.splits, eve) is None:
        raise ValueError(f"no record of the splits applied up to {eve}: start or load that day")
    executed = F.to_date("execution_date")
    (before_on, before), (after_on, after) = (_ledger(spark, tables, on) for on in (eve, day))
    splits = active_splits(after)
    rows = splits.filter(executed == F.lit(day))
    if after_on != before_on:
        old = executed.between(F.lit(day - timedelta(days=WINDOW_DAYS)), F.lit(eve))
        late = changed_ratios(active_splits(before).filter(old), splits.filter(old))
        rows = rows.unionByName(late)
    return _dated(rows, day)


def run_day(spark: SparkSession, tables: Tables, feeds: Feeds, day: date) -> None:
    """Load one day; late, corrected and withdrawn splits restate the arrays before the day's own step. Any failed check
    leaves that table's published partition as it was."""
    bars = read_daily_bars(spark, feeds.bars, day)
    replace_table(
        bars,
        tables.staged_bars,
        BARS,
        partition_by=["snapshot_date"],
        sort_by=["ticker"],
        measured=[*checks.bar_checks(), checks.day_check(day)],
    )
    staged = read_table(spark, tables.staged_bars, BARS)
    checks.run_checks(checks.check_unique(staged))

    read_new_splits(spark, tables, feeds, day)
    publish_partition(
        _new_splits(spark, tables, day),
        tables.splits,
        SPLITS,
        day,
        measured=checks.split_checks(),
    )

    before = tables.arrays_of(spark, day - timedelta(days=1))
    published = read_partition(spark, tables.splits, SPLITS, day)
    is_late = F.to_date("execution_date") < F.lit(day)
    late = published.filter(is_late)
    # Most days have none, and then the arrays need no further join.
    restated = before if late.isEmpty() else restate(before, late)
    publish_partition(
        daily_step(restated, staged, published.filter(~is_late), day),
        tables.cumulative,
        CUMULATIVE,
        day,
        checks=lambda rows: [checks.check_growth(rows, before)],
        sort_by=["ticker"],
        buckets=tables.buckets,
    )
    publish_partition(
        dim_prices(tables.arrays_of(spark, day), day), tables.prices, DIM_PRICES, day
    )


def run_days(
    spark: SparkSession, tables: Tables, feeds: Feeds, first: date, last: date
) -> None:
    """Catch up in order: each day reads the partition the day before published."""
    for offset in range((last - first).days + 1):
        run_day(spark, tables, feeds, first + timedelta(days=offset))


def load_details(
    spark: SparkSession, tables: Tables, documents: str, run_date: date, lines: bool = False
) -> None:
    """Add a snapshot of the instrument details, or replace the one of the same date."""
    rows = ticker_details(read_ticker_documents(spark, documents, not lines), run_date)
    overwrite_partitions(
        rows,
        tables.details,
        TICKER_DETAILS,
        ["as_of_date"],
        ["asset_type", "market_cap_description"],
    )
