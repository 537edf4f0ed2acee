"""Published partitions: immutable version folders, and a log that says which are current.

A version is written once, to a folder of its own, and never moved or changed. It becomes current
when an empty file is created in the table's log, whose name holds a number, the partition and the
version: creating an empty file is a single step on every storage, so at any moment a reader finds
either the old version or the new one. Readers list the log and take the last entry of each
partition, or, for a snapshot, the last up to a number. Nothing is renamed or overwritten.

One writer at a time may publish a partition; different partitions may be published at once.
"""

from __future__ import annotations

import uuid
from datetime import timedelta
from typing import NamedTuple

from pyspark.sql import SparkSession

from . import folders

# Readers of the plain folder skip names that start with an underscore.
VERSIONS = "_versions"
_LOG = "_published"


class Entry(NamedTuple):
    """A version that was made current: its place in the log, its partition, its folder's name."""

    number: int
    partition: str
    version: str

    @property
    def name(self) -> str:
        return f"{self.number:012d}~{self.partition}~{self.version}"


def _entry(name: str) -> Entry:
    number, partition, version = name.split("~")
    return Entry(int(number), partition, version)


def new_version(table: str, partition: str) -> str:
    """A folder for the next version of a partition (``column=value``)."""
    return f"{table}/{VERSIONS}/{partition}/v-{uuid.uuid4().hex}"


def log(spark: SparkSession, table: str) -> list[Entry]:
    """All entries, oldest first. Of two writers' entries of one number the later name wins, for
    every reader alike."""
    return sorted(map(_entry, folders.children(spark, f"{table}/{_LOG}")))


def is_versioned(spark: SparkSession, table: str) -> bool:
    return folders.exists(spark, f"{table}/{_LOG}")


def snapshot(spark: SparkSession, table: str) -> int:
    """The number of the newest entry: what a reader passes on to read the same state again."""
    entries = log(spark, table)
    return entries[-1].number if entries else 0


def current(spark: SparkSession, table: str, at: int | None = None) -> dict[str, str]:
    """Partition -> folder of its current version, or of the one current at a snapshot."""
    found = {}
    for entry in log(spark, table):
        if at is None or entry.number <= at:
            found[entry.partition] = f"{table}/{VERSIONS}/{entry.partition}/{entry.version}"
    return found


def switch(spark: SparkSession, table: str, folder: str) -> int:
    """Make a written version current; returns the snapshot it begins."""
    partition, version = folder.rsplit("/", 2)[1:]
    entry = Entry(snapshot(spark, table) + 1, partition, version)
    folders.create(spark, f"{table}/{_LOG}/{entry.name}")
    return entry.number


def forget(spark: SparkSession, table: str, partition: str, keep_for: timedelta) -> None:
    """Delete what a partition no longer needs: versions replaced at least ``keep_for`` before the
    table's newest entry, and folders that no entry names (a driver lost before the switch) last
    changed as long ago. Only the storage's times are compared."""
    entries = log(spark, table)
    if not entries:
        return
    written = {e: folders.modified(spark, f"{table}/{_LOG}/{e.name}") or 0 for e in entries}
    now = max(written.values())

    def is_old(time: int | None) -> bool:
        return time is not None and timedelta(milliseconds=now - time) >= keep_for

    own = [entry for entry in entries if entry.partition == partition]
    for old, successor in zip(own, own[1:], strict=False):
        if is_old(written[successor]):
            # The entry first: a folder without one is deleted by a later call.
            folders.delete(spark, f"{table}/{_LOG}/{old.name}")
    named = {entry.version for entry in log(spark, table) if entry.partition == partition}
    root = f"{table}/{VERSIONS}/{partition}"
    for name in folders.children(spark, root):
        if name not in named and is_old(folders.modified(spark, f"{root}/{name}")):
            folders.delete(spark, f"{root}/{name}")
