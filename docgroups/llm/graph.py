"""Connected components by rounds of star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgroups.session import cut


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of ``(a, b)``: the smallest node that each end of an edge can reach.

    Large-star and small-star rounds: every node passes its larger, then its smaller neighbours on to the
    smallest it knows. Minima are combined before their shuffle, edges stay as many or fewer, each
    round is written, and rounds grow with the logarithm of the nodes.
    """
    edges = cut(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    if edges.isEmpty():
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    while True:
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("low").alias("a"), "b").where("a <> b").distinct()
        # Now b is the larger end: every node joins its smaller neighbours, and itself, to the smallest.
        large = cut(large)
        least = large.groupBy("b").agg(F.min("a").alias("low"))
        moved = large.join(least, "b").select("low", "a", "b")
        small = moved.select(F.col("low").alias("a"), F.col("a").alias("b")).union(moved.select(F.col("low").alias("a"), "b"))
        after = cut(small.where("a <> b").distinct())
        # Done when every component is a star around its smallest node: no node is both a centre and a leaf.
        if after.select(F.col("a").alias("n")).distinct().join(after.select(F.col("b").alias("n")).distinct(), "n", "left_semi").isEmpty():
            leaves = after.groupBy("b").agg(F.min("a").alias("component"), F.max("a").alias("top"))
            if leaves.where("component <> top").isEmpty():
                leaves = leaves.select(F.col("b").alias("node"), "component")
                centres = after.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
                return leaves.unionByName(centres)
        edges = after
