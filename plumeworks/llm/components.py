"""Connected components of a table of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """One round: every node's neighbours are tied to its smallest one. Nodes are aggregated before they are joined."""
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    around = both if large else both.where("v < u")
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    tied = around.join(least, "u")
    moved = tied.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) if large else tied.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for every node of ``links`` (u, v). Link order and repeats don't matter."""
    edges = materialise(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "links")
    seen = None
    while True:
        edges = materialise(_stars(_stars(edges, True), False), "links")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
