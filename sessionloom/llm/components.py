"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node each node can reach. ``edges`` has two long columns, a and b.

    Rounds of large star and small star: every node's larger neighbours are linked to its smallest one,
    then every node and its smaller neighbours are. Each round's edges are written to the shared
    folder. Minima are aggregated before they are shuffled and joined back by node, so a node with very
    many neighbours is never collected. The loop ends when a round changes no edge, after about
    log(n) rounds.
    """
    # Each edge once, from its larger to its smaller node.
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = stored(links.filter(F.col("a") != F.col("b")).distinct(), "links")
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        near = least.withColumnRenamed("a", "_a")
        # Large star: a neighbour larger than the node goes to the node's smallest.
        large = both.filter(F.col("b") > F.col("a")).join(near, F.col("a") == F.col("_a"))
        large = large.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        large = stored(large.filter(F.col("a") != F.col("b")), "links")
        # Small star: a node and its smaller neighbours go to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        near = least.withColumnRenamed("a", "_a")
        small = large.join(near, F.col("a") == F.col("_a"))
        small = small.select(F.col("b").alias("a"), F.col("least").alias("b"))
        after = small.unionByName(least.select("a", F.col("least").alias("b")))
        after = stored(after.filter(F.col("a") != F.col("b")).distinct(), "links")
        if _sum(after) == _sum(links):
            break
        links = after
    return after.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _sum(links: DataFrame) -> tuple:
    """Number and hash sum of the edges, which two rounds share only if they have the same edges."""
    h = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(links.agg(F.count(F.lit(1)), F.sum(h)).first())
