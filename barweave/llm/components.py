"""Connected components of a graph that is spread over the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barweave.llm.scratch import checkpointed


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable from each node of the edges (u, v).

    Rounds of large-star and small-star: every node points its larger neighbours, then its smaller
    ones, to the smallest node it knows, until nothing changes and all point to their component's
    smallest. A round is two aggregations and joins of the links; the number of rounds grows with
    the logarithm of the longest path. Repeated edges, loops and no edges at all are fine.
    """
    links = checkpointed(
        edges.selectExpr("greatest(u, v) AS u", "least(u, v) AS v").where("u > v").distinct()
    )
    state = _state(links)
    while True:
        both = links.unionByName(links.selectExpr("v AS u", "u AS v"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.where("v > u").join(least, "u").selectExpr("v AS u", "least(u, m) AS v")
        down = large.distinct()
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u")
        small = small.selectExpr("v AS u", "m AS v").unionByName(small.selectExpr("u", "m AS v"))
        links = checkpointed(small.where("u > v").distinct())
        before, state = state, _state(links)
        if state == before:
            break
    named = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return named.unionByName(roots.distinct())


def _state(links: DataFrame) -> tuple:
    """Count and a checksum of the links: equal for equal sets."""
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
