"""Connected components of a graph given by its edges, as joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetloom.session import release, scratch_table


def _least(edges: DataFrame) -> DataFrame:
    """Each ``a`` with the least of its ``b``; written, so a hot ``a`` can be split in a join."""
    return scratch_table(edges.groupBy("a").agg(F.min("b").alias("_m")), "least")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node, component (its least node) of every node that stands in ``edges`` (a, b: bigint).

    Large-star and small-star steps in turn, until the edges are stars: each node's
    neighbours are hung to the least one. The number of rounds grows with the logarithm
    of the longest path.
    """
    now = scratch_table(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while (state := _state(now)) != before:
        before = state
        both = scratch_table(now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges-both")
        large = both.join(_least(both), "a").where("b > a").select(F.col("b").alias("a"), F.least("_m", "a").alias("b")).distinct()
        large = scratch_table(large, "edges-large")
        release(both)
        least = _least(large)
        small = large.join(least, "a").where("b <> _m").select(F.greatest("b", "_m").alias("a"), F.least("b", "_m").alias("b"))
        following = scratch_table(small.unionByName(least.select("a", F.col("_m").alias("b"))).distinct(), "edges")
        release(large, least, now)
        now = following
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
