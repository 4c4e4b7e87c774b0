"""Connected components by alternating large-star and small-star rounds over distinct links. A node with very many links is one
row of the least neighbours and is joined with its links by salted copies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cleared, durable, salted_join


def _large_star(links: DataFrame) -> DataFrame:
    """Each node tells its larger neighbours the least node next to it."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least, larger = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), both.filter("v > u")
    return salted_join(larger, least, ["u"], larger.groupBy("u").agg(F.count("*").alias("n")), ["v"]).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Each node tells its smaller neighbours, and itself, the least of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    near = salted_join(down, least, ["u"], down.groupBy("u").agg(F.count("*").alias("n")), ["v"]).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.unionByName(least.select("u", F.col("m").alias("v")))


def connected_components(links: DataFrame) -> DataFrame:
    """links(u, v), any order, loops allowed: node, component (its least node); nodes without a link to another are left out."""
    now = durable(links.select("u", "v").filter("u <> v").distinct(), clear=True)
    if now.isEmpty():
        return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    seen = None
    while True:
        now = durable(_large_star(now).filter("u <> v").distinct(), clear=True)
        now = durable(_small_star(now).filter("u <> v").distinct(), clear=True)
        with cleared(now.sparkSession):
            state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = state
