"""Connected components of a table of links between long ids, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm import common


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    joined = both.join(least, "a").where("b > a")
    return joined.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked to the smallest."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    joined = links.join(least, "a").where("b <> least")
    moved = joined.select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select("a", F.col("least").alias("b"))).distinct()


def roots(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``(a, b)`` for every node but the smallest of its component: ``b`` is the smallest.

    ``links`` holds longs a and b in either direction; loops, repeats and rows with a null
    are ignored. The rounds grow with the logarithm of the longest chain; each is written to
    the shared folder, nothing is collected but two counts.
    """
    ordered = links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    current = common.stage(ordered.distinct(), "links")
    for _ in range(max_rounds):
        # done when each node has one parent and no parent has one
        nodes = current.groupBy("a").count()
        chained = current.select("b").distinct().join(nodes, F.col("b") == F.col("a"), "left_semi")
        if not nodes.where("count > 1").take(1) and not chained.take(1):
            return current
        current = common.stage(_small_star(_large_star(current)), "links")
    raise RuntimeError(f"components not settled after {max_rounds} rounds")
