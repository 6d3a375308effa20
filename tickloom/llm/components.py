"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickloom.session import scratch, staged


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected with, for every node
    of ``edges`` (``a``, ``b``: long) but the roots.

    Large-star and small-star steps in turn hang every node below the smallest one
    it can see, until nothing moves: about the logarithm of the longest path in
    rounds. Nodes of any degree only ever meet in aggregates and joins; each round
    is written to the shared folder, so no plan grows. No edges give no rows."""
    low, high = F.least("a", "b"), F.greatest("a", "b")
    now = staged(edges.filter("a <> b").select(high.alias("a"), low.alias("b")).distinct())
    mark = _signature(now)
    while mark[0]:
        with scratch(_large_star(now)) as large:
            after = staged(_small_star(large))
        seen = _signature(after)
        now = after
        if seen == mark:
            break
        mark = seen
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _signature(edges: DataFrame) -> tuple:
    digest = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), digest).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves below the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    moved = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
    return moved.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, move below the smallest."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
