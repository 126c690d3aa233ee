"""Connected components of an edge table, by alternating star contractions in Spark.

Every node's edges are moved to its smallest neighbour until each component is a star around its smallest node; the
number of rounds grows with the logarithm of the longest path. Nothing but a count and a checksum goes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle


def components(edges: DataFrame, tag: str = "stars") -> DataFrame:
    """(node, root) for each node of ``edges`` (columns a, b); root is the smallest node of its component."""
    now = settle(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), tag)
    before = None
    while True:
        at = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if at[0] == 0 or at == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select("v", "v")).groupBy("node").agg(F.min("root").alias("root"))
        before = at
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = settle(large.where("u <> v"), tag)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", "m"))
        now = settle(small.where("u <> v").distinct(), tag)
