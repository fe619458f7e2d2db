"""Connected components of a graph of links, by alternating large and small stars.

Every round is a few joins and map-side aggregates over the edges that are left; no node's
neighbours meet in one task, and only two numbers a round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fixtrail.operators.staging import stage


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node of the component) for every node of ``edges`` (x, y: long)."""
    down = edges.where(F.col("x") != F.col("y")).select(
        F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")
    )
    down, seen = stage(down.distinct(), "edges"), None
    while True:
        both = down.unionAll(down.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = stage(small.unionAll(low.select("u", F.col("m").alias("v"))).distinct(), "stars")
        now = down.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    return down.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        down.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
