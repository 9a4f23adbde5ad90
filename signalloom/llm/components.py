"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalloom.llm.common import discard, keep


def components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node it reaches) of every node in links (a, b: two bigint nodes); loops and repeated links do no harm.

    Each round hangs every node's larger neighbours, then its smaller ones, onto the smallest neighbour, which keeps what is
    connected connected and ends in stars around the roots. Rounds are written to the shared folder; only counts reach the driver.
    """
    edges = keep(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    said = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == said or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        said = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = keep(large.where("u <> v").distinct(), "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        before, edges = edges, keep(small.where("u <> v").distinct(), "links")
        discard(before, large)
