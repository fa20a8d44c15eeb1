"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Greater neighbours of a node move to the smallest node it sees."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return (both.join(least, "a").filter(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and the node, move to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, root`` for every node of ``edges(a, b)``; root is the smallest node reachable.

    Each round is written to the shared checkpoint folder. The number of
    rounds grows with the logarithm of the longest path. Only a count and a
    checksum reach the driver. Self links and repeated links are allowed.
    """
    cur = staged(edges.filter("a != b").select("a", "b").distinct(), name)
    before = None
    while True:
        cur = staged(_small_star(_large_star(cur)), name)
        sign = tuple(cur.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if sign == before:
            break
        before = sign
    roots = cur.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(cur.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
