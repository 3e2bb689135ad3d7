"""Connected components of a distributed edge list by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.llm.common import written


def _settled(current: DataFrame) -> bool:
    """Whether every node of the distinct links (u, v) is either a root or has one link, to a root."""
    ends = current.select(F.col("u").alias("node"), F.lit(1).alias("links")).union(
        current.select("v", F.lit(0)))
    return ends.groupBy("node").agg(F.sum("links").alias("links"), F.min("links").alias("least")).where(
        "links > 1 OR links = 1 AND least = 0").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b), root being the component's smallest node.

    Each round links the larger neighbours of a node, then the smaller ones, to its
    smallest neighbour, until every node hangs on its root; the rounds grow with the
    logarithm of the longest chain.  Only minima are grouped, so a node with very many
    links costs one row per map task.  Self links and null ends are ignored; no links
    give no rows.
    """
    ends = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    current = written(ends.where("u > v").distinct(), "links")
    while not _settled(current):
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("v"), F.least("u", "m").alias("m"))
        large = current.join(least, "v").select("u", F.col("m").alias("v")).distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        # the link to the smallest neighbour itself stays, every other hangs its end on that neighbour
        hung = F.when(F.col("v") > F.col("m"), F.col("v")).otherwise(F.col("u"))
        current = written(large.join(small, "u").select(hung.alias("u"), F.col("m").alias("v")).distinct(), "links")
    nodes = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
