"""Connected components of a graph of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.session import cut_lineage, release


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the smallest node about it."""
    both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.filter("v > u").join(least, "u").select(
        F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link the smaller neighbours of a node, and the node, to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every linked node: root is the smallest node it can reach.

    Both steps keep what is connected and leave at most one row per node and root; every round
    is written to the shared folder. The links are stars when a round changes nothing, after a
    number of rounds that grows with the logarithm of the nodes. Links to oneself and null ends
    are ignored, repeated links count once.
    """
    links = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").distinct()
    links = cut_lineage(links)
    if links.isEmpty():
        return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    told = None
    while True:
        large = cut_lineage(_large_star(links))
        last, links = links, cut_lineage(_small_star(large))
        release(last, large)
        now = links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")),
                        F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if now == told:
            break
        told = now
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
