"""Connected components of a link table, by alternating stars over joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, stage


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or itself)."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a < b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a")
    return (moved.select(F.col("m").alias("x"), F.col("b").alias("y")).unionByName(least.select(F.col("m").alias("x"), F.col("a").alias("y")))
            .where("x < y").distinct().select(F.col("x").alias("a"), F.col("y").alias("b")))


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for each node of ``links(a long, b long)``; root is its component's smallest node.

    Each round is one large and one small star, staged in the shared folder; the links shrink to a
    star per component in a number of rounds that grows with the logarithm of the longest path.
    Minima are pre-aggregated, so a node with very many links costs one row per task.
    """
    spark = links.sparkSession
    links = stage(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    mark = None
    for _ in range(rounds):
        links = stage(_small_star(_large_star(links)), "stars")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        release(spark)
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return links.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(links.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
