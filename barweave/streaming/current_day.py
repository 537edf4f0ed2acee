"""Keep the current-day table up to date from a stream of quotes."""

from __future__ import annotations

import json
from datetime import date, timedelta
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ..plans.daily import Tables
from ..plans.intraday import apply_quotes, changed_rows
from ..plans.reference_prices import init_current_day
from ..schemas import CURRENT_DAY, CURRENT_DAY_ARRIVED, DIM_PRICES, TICKER_DETAILS
from ..sinks import folders
from ..sinks.tables import conform
from ..sources.tables import read_newest_partition, read_partition

# A whole table, and the rows that one batch changed.
_VERSION, _DELTA = "v=", "d="
#: Deltas on top of a whole version, at most: the next batch writes the table whole again.
COMPACT_AFTER = 16


class _Version(NamedTuple):
    """A complete version: its place in the order, who wrote it, when, and its folder's name."""

    number: int
    writer: str
    written: int
    name: str

    @property
    def is_whole(self) -> bool:
        return self.name.startswith(_VERSION)


def _versions(spark: SparkSession, table: str) -> list[_Version]:
    found = []
    for name in folders.children(spark, table):
        if not name.startswith((_VERSION, _DELTA)):
            continue
        written = folders.modified(spark, f"{table}/{name}/_SUCCESS")
        if written is not None:
            number, _, writer = name[len(_VERSION) :].partition("_")
            found.append(_Version(int(number), writer, written, name))
    if not any(version.is_whole for version in found):
        raise ValueError(f"{table} has no version: start the day first")
    return sorted(found)


def _newest_state(versions: list[_Version]) -> list[_Version]:
    """The last whole version and the deltas after it."""
    last = max(at for at, version in enumerate(versions) if version.is_whole)
    return versions[last:]


def _read_state(
    spark: SparkSession, table: str, state: list[_Version], schema: StructType = CURRENT_DAY
) -> DataFrame:
    """The whole version with each ticker's last changed row in place of its own. The deltas
    together are as long as the batches since."""
    whole, *deltas = state
    rows = spark.read.schema(schema).parquet(f"{table}/{whole.name}")
    if not deltas:
        return rows
    column = _DELTA.rstrip("=")
    folders_ = [f"{table}/{version.name}" for version in deltas]
    stored = StructType([*schema, StructField(column, StringType())])
    changed = spark.read.schema(stored).option("basePath", table).parquet(*folders_)
    number = F.split_part(column, F.lit("_"), F.lit(1)).cast("bigint")
    values = F.struct(*schema.fieldNames())
    last = changed.groupBy("ticker").agg(F.max_by(values, number).alias("row"))
    last = last.select("row.*")
    kept = rows.join(last.select("ticker"), "ticker", "left_anti")
    return kept.unionByName(last)


def _write_version(
    frame: DataFrame, table: str, number: int, writer: str, kind: str = _VERSION
) -> None:
    folder = f"{table}/{kind}{number}_{writer}"
    schema = CURRENT_DAY_ARRIVED if "arrival" in frame.columns else CURRENT_DAY
    conform(frame, schema).write.mode("overwrite").parquet(folder)


def initialise(current: DataFrame, table: str) -> None:
    """Start the day: drop the versions of the day before and write the first."""
    folders.delete(current.sparkSession, table)
    _write_version(current, table, 0, "start")


def start_day(spark: SparkSession, tables: Tables, day: date) -> None:
    """Start from the reference prices of ``day`` and the newest instrument details."""
    prices = read_partition(spark, tables.prices, DIM_PRICES, day)
    details = read_newest_partition(spark, tables.details, TICKER_DETAILS)
    initialise(init_current_day(prices, details, day), tables.current)


def read_current(spark: SparkSession, table: str) -> DataFrame:
    """The newest state: the last whole version and what batches have changed since."""
    return _read_state(spark, table, _newest_state(_versions(spark, table)))


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream is given with its checkpoint, and keeps when it is restarted."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]


def _forget(spark: SparkSession, table: str, keep_for: timedelta) -> None:
    """Delete what the next whole version replaced at least ``keep_for`` before the newest version
    was written. Only the storage's times are compared."""
    versions = _versions(spark, table)
    old = [
        version.number
        for version in versions
        if version.is_whole
        and timedelta(milliseconds=versions[-1].written - version.written) >= keep_for
    ]
    for version in versions:
        if old and version.number < old[-1]:
            folders.delete(spark, f"{table}/{version.name}")


def start_updates(
    quotes: DataFrame,
    table: str,
    checkpoint: str,
    last_write_wins: bool = False,
    interval: str | None = None,
    keep_for: timedelta = timedelta(hours=1),
    compact_after: int = COMPACT_AFTER,
) -> StreamingQuery:
    """Merge every micro-batch into ``table``. Without ``interval`` the available input is
    processed and the query ends; with it, the query polls until stopped.

    A batch writes the rows it changes, and no others, to a folder of its own; readers put them in
    place of the whole version's. After ``compact_after`` such deltas a batch writes the table
    whole. Folders are named after the stream and the batch: a batch repeated after a failure is recognised, one of another stream
    (a new checkpoint over an old table) is never taken for it, and a half-written version (no
    success marker) is never read. A replaced version stays for ``keep_for``, for those who are
    still reading it. One stream at a time may update a table. ``last_write_wins`` needs a stream
    with the quotes' arrival, which is stored beside the prices.
    """
    if last_write_wins and "arrival" not in quotes.columns:
        raise ValueError("last_write_wins needs quotes with their arrival")

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        versions = _versions(spark, table)
        writer = f"{_stream_id(spark, checkpoint)}_{batch_id}"
        if any(version.writer == writer for version in versions):
            return
        # A version that no arrival was written to reads back with none.
        schema = CURRENT_DAY_ARRIVED if last_write_wins else CURRENT_DAY
        state = _newest_state(versions)
        current = _read_state(spark, table, state, schema)
        whole = len(state) > compact_after
        merged = apply_quotes if whole else changed_rows
        rows = merged(current, batch, last_write_wins)
        kind = _VERSION if whole else _DELTA
        _write_version(rows, table, versions[-1].number + 1, writer, kind)
        _forget(spark, table, keep_for)

    writer = quotes.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    if interval:
        return writer.trigger(processingTime=interval).start()
    return writer.trigger(availableNow=True).start()


def run_for(query: StreamingQuery, minutes: float) -> None:
    """Let an interval query run for a trading session, then stop it."""
    query.awaitTermination(minutes * 60)
    query.stop()
