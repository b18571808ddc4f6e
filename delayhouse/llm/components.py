"""Connected components of an edge table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _star(edges: DataFrame, node: str, other: str) -> DataFrame:
    """Every edge with the smallest neighbour of ``node``, the node itself included."""
    lowest = edges.groupBy(node).agg(F.min(other).alias("lowest"))
    return edges.join(lowest, node).withColumn("lowest", F.least("lowest", node))


def connected(edges: DataFrame, stage: Callable[[DataFrame, str], DataFrame] = staged) -> DataFrame:
    """(node, component) for all nodes of ``edges`` (a, b); the component is the smallest node that can be reached.

    Alternates large and small stars: each node hands the smallest neighbour it knows to its larger, then to its smaller
    neighbours, until every node points at its root; ``stage`` writes what a round leaves. A hot node is a key of a sum-like aggregate and of a join only. Null ends
    and loops are ignored; an empty table gives an empty result.
    """
    now = stage(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    before = None
    while True:
        mark = tuple(now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
        if mark == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, "u", "v").filter("v > u").select(F.col("v").alias("u"), F.col("lowest").alias("v")).distinct()
        small = _star(large, "u", "v")
        handed = small.select(F.col("v").alias("u"), F.col("lowest").alias("v"))
        own = small.select("u", F.col("lowest").alias("v"))
        now = stage(handed.unionByName(own).filter("u > v").distinct(), "cc")
