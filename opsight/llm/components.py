"""Connected components of a list of links, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from opsight.session import cut_lineage


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, for every node with a link to another one.

    Alternates large-star (every larger neighbour is tied to the smallest one) and small-star (every smaller
    neighbour is), until the links are stars; the rounds grow with the logarithm of the longest chain. A
    round is a grouping with partial minima and a join, and is written to the checkpoint folder. Links with
    a null end or of a node with itself say nothing and are left out. Nothing but two sums comes to the driver.
    """
    links = links.select(F.greatest(left, right).alias("a"), F.least(left, right).alias("b")).where(
        F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col(left) != F.col(right))).distinct()
    links = cut_lineage(links)
    before = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = both.join(least, "a").where("b > a").select(
            F.col("b").alias("a"), F.least("a", "m").alias("b")).where("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
        links = cut_lineage(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
