"""Connected components of a table of links, by alternating star contraction.

Each round every node's larger neighbours are hung on its smallest neighbour (large star), then every
node with its smaller neighbours on the smallest of them (small star). The number of links never
grows beyond a few per node, chains halve, and nothing but a count and a checksum reaches the driver.
Only minima are aggregated, so a node with a third of all links is combined in the map tasks.
Each round is written below ``spark.checkpoint.dir``, which cuts the lineage.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pulserank.llm.common import materialise


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    hung = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): each linked node and the smallest node it reaches, itself included.

    Links have no direction; repeated ones and those of a node with itself or with null change nothing.
    No links give no rows.
    """
    x, y = F.col(a), F.col(b)
    links = links.where(x != y).select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct()
    links = materialise(links, "links")
    before = _state(links)
    while before[0]:
        links = materialise(_small_star(_large_star(links)), "links")
        now = _state(links)
        if now == before:
            break
        before = now
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
