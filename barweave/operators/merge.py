"""Matched-update merge for tables without a row-level format."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_matched(
    target: DataFrame, source: DataFrame, key: str, columns: list[str]
) -> DataFrame:
    """Overwrite ``columns`` of target rows whose key is in source; insert and delete nothing.

    A matched NULL overwrites. Two source rows with one key are an error, as in SQL MERGE; the
    count that detects it shares the join's partitioning, so it adds no shuffle.
    """
    unique = (
        source.groupBy(key)
        .agg(F.count("*").alias("n"), *[F.first(name).alias(f"new_{name}") for name in columns])
        .withColumn(
            "matched",
            F.when(F.col("n") == 1, F.lit(True)).otherwise(
                F.raise_error(F.concat(F.lit("several updates for "), F.col(key)))
            ),
        )
        .drop("n")
    )
    joined = target.join(unique, key, "left")
    return joined.select(
        *[
            F.when(F.col("matched"), F.col(f"new_{name}")).otherwise(F.col(name)).alias(name)
            if name in columns
            else F.col(name)
            for name in target.columns
        ]
    )
