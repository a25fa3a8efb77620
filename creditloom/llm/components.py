"""Connected components of an edge table, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import dropped, kept


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect every larger neighbour of a node to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    rest = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node with an edge but the roots themselves; the root is the smallest node reachable.

    ``edges`` has ``a`` and ``b``; loops and repeats are ignored. Each round is
    written to the shared folder; rounds grow with the logarithm of a path's
    length. A node with very many edges is combined map-side and its join is
    split by adaptive execution.
    """
    now = kept(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        state = now.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if state == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state
        following = kept(_small_star(_large_star(now)), "edges")
        dropped(now)
        now = following
