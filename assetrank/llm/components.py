"""Connected components of a link table by repeated minimum-label steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetrank.llm import tables


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: long, not null); the root
    is the smallest node reachable.

    Each round turns the links so that every node points at smaller neighbours
    (large-star, then small-star), which roughly halves the depth of all trees;
    it ends when a round changes nothing. Every aggregate is partial before its
    shuffle and no neighbourhood is collected. Tables are written between rounds.
    """
    now = tables.stored(_both_ways(links).where("a <> b").distinct(), "links")
    state = None
    while True:
        now = tables.stored(_small_star(_large_star(now)), "links")
        was, state = state, now.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if was == state:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b")).distinct()


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """Connect every larger neighbour of a node with the smallest of it and its neighbours."""
    both = _both_ways(links)
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Connect every smaller neighbour of a node, and the node, with the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()
