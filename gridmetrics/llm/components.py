"""Connected components of an edge table, by alternating large and small stars.

Every step is a grouped minimum and a join on the same key, so a node with very many neighbours is
pre-aggregated and its join can be split. Steps are written to shared storage; nothing but
two numbers for each step reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); the root is the component's least node."""
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    pairs = stored(pairs.where("u <> v").distinct())
    before = None
    while True:
        mark = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            return pairs.groupBy("u").agg(F.min("v").alias("root")).select(
                F.col("u").alias("node"), "root"
            ).unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = mark
        pairs = stored(_small_star(_large_star(pairs)))


def _large_star(pairs: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours to the least node it knows."""
    both = pairs.unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return (
        both.join(least, "u")
        .where("v > u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .where("u <> v")
        .distinct()
    )


def _small_star(pairs: DataFrame) -> DataFrame:
    """Each node hands its smaller neighbours, and itself, to the least of them."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    handed = pairs.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return handed.unionAll(own).where("u <> v").distinct()
