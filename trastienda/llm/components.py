"""Connected components of a graph that lies in files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trastienda.sources.settle import settle


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of the edges (a, b) can reach.

    Every round hangs each node's neighbours on the smallest of them (once for larger
    neighbours, once for smaller ones), until nothing changes. Edges stay stars, never all pairs, and
    each round is written to the shared folder.
    """
    edges = settle(_ordered(edges))
    if not edges.take(1):
        return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
        hung = settle(_ordered(both.where("b > a").join(least, "a").select(F.col("least").alias("a"), "b")))
        # the other way: a node hangs, with its smaller neighbours, on the smallest of those
        down = hung.select(F.col("b").alias("node"), F.col("a").alias("low"))
        lowest = down.groupBy("node").agg(F.min("low").alias("least"))
        moved = down.join(lowest, "node").where("low > least").select(F.col("least").alias("a"), F.col("low").alias("b"))
        after = settle(_ordered(moved.unionByName(lowest.select(F.col("least").alias("a"), F.col("node").alias("b")))))
        if not moved.take(1) and _stars(after):
            return after.select(F.col("b").alias("node"), F.col("a").alias("root"))
        edges = after


def _ordered(edges: DataFrame) -> DataFrame:
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether no node is both a root and below one."""
    return not edges.join(edges.select(F.col("a").alias("b")).distinct(), "b", "left_semi").take(1)
