"""Exact positions in a sort order that is spread over the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barweave.llm.scratch import checkpointed

#: A table of group names and numbers is sent to all tasks up to so many bytes, beyond it is joined.
SENT_BYTES = 8 << 20


def ranked(df: DataFrame, keys: list[str]) -> DataFrame:
    """The rows with ``rank``, their place in the order of the keys, from 0, nulls first.

    The rows are dealt out by ranges and sorted once; what is summed up are the numbers of rows of
    the partitions. Rows that tie in all keys keep some order.
    """
    rows = checkpointed(df.withColumn("tie", F.monotonically_increasing_id()))
    rows = rows.repartitionByRange(*keys, "tie").sortWithinPartitions(*keys, "tie")
    # This id is the partition's number, then the row's place in the partition.
    rows = checkpointed(rows.withColumn("place", F.monotonically_increasing_id()))
    rows = rows.withColumn("task", F.shiftright("place", 33))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = rows.groupBy("task").agg(F.count(F.lit(1)).alias("own"))
    skipped = F.coalesce(F.sum("own").over(before), F.lit(0)) - F.shiftleft("task", 33)
    # One row for each partition: its size is bounded by the number of partitions.
    tasks = F.broadcast(tasks.select("task", skipped.alias("skipped")))
    rank = (F.col("place") + F.col("skipped")).alias("rank")
    return rows.join(tasks, "task").select(*df.columns, rank)


def numbered(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """The rows with ``tree``, the place of their group among all groups, ``at``, their place in
    the group, and ``size``, the rows of the group; places count from 0, nulls come first."""
    rows = checkpointed(ranked(df, [group, *order]))
    groups = rows.groupBy(F.col(group).alias("same")).agg(
        F.min("rank").alias("begin"), F.count(F.lit(1)).alias("size")
    )
    groups = checkpointed(ranked(groups, ["same"]).withColumnRenamed("rank", "tree"))
    name = F.coalesce(F.octet_length(F.col("same").cast("string")), F.lit(0))
    sent = groups.agg(F.sum(name + 64)).first()[0] or 0
    groups = F.broadcast(groups) if sent <= SENT_BYTES else groups
    found = rows.join(groups, F.col(group).eqNullSafe(F.col("same")))
    return found.select(*df.columns, "tree", F.expr("rank - begin").alias("at"), "size")
