"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import saved


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where(F.col("b") > F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and root, the smallest node reachable, of every node that has a link to another.

    Each round is written to the shared folder; nodes with many links cost rows, not one task, as both stars
    are an aggregation and a join. Links of a node to itself and nulls are ignored.
    """
    links = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a > b").distinct()
    links, seen = saved(links, "links", small=True), None
    while True:
        # the small star leaves each node one link to the smallest node it knows of; done once no large star moves any
        links = saved(_small_star(_large_star(links)), "links", small=True)
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = now
