"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.shared import stored


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (``a, b``): the smallest node it is connected with.

    Each round joins every node to the smallest of its neighbours and itself, first its larger
    neighbours, then its smaller ones; all that leaves a round is a star around the smallest node
    when nothing changes any more. Rounds grow with the logarithm of the longest chain. Nothing is
    collected but one count and one sum a round. Null ends are ignored; no links give no rows.
    """
    edges = stored(links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    while True:
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        larger = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        up = larger.union(low.where("m < u").select("u", F.col("m").alias("v"))).where("u > v").distinct()
        least = up.groupBy("u").agg(F.min("v").alias("m"))
        down = up.join(least, "u").select(F.explode(F.array("u", "v")).alias("x"), "m").where("x > m").select(F.col("x").alias("u"), F.col("m").alias("v"))
        edges = stored(down.distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
        if now == before:
            break
        before = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(edges.select("v", "v")).distinct()
