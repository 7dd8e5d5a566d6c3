"""Connected components of a link table, by alternating large and small stars.

Each round rewires every link to a smaller neighbour of its ends, in joins and
partial aggregates only, and writes the links to the shared scratch folder.
The rounds grow with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import Scratch


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    around = _both_ways(links)
    least = around.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    larger = around.where(F.col("b") > F.col("a"))
    return larger.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(least, "a")
    others = joined.where(F.col("b") > F.col("m")).select(F.col("b").alias("a"), "m")
    return others.union(joined.select("a", "m")).select("a", F.col("m").alias("b"))


def _state(links: DataFrame) -> tuple:
    """Rows and an order-free digest of a link table."""
    digest = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(links.agg(F.count("*"), digest).first())


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for every node of `links` (a, b: long); the label is the least node.

    Links of a node to itself are ignored. Nodes without a link have no row.
    """
    current = scratch.save(links.where(F.col("a") != F.col("b")).select("a", "b").distinct())
    before = None
    while (now := _state(current)) != before and now[0]:
        starred = _small_star(_large_star(current)).where(F.col("a") != F.col("b")).distinct()
        following = scratch.save(starred)
        scratch.drop(current)
        current, before = following, now
    roots = current.select(F.col("b").alias("node")).distinct()
    stars = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(roots.select("node", F.col("node").alias("component")))
