"""Connected components of a link table, by alternating large-star and small-star steps.

Every step is a pair of grouped minima and joins over the links; nothing goes to the driver but
two numbers that tell whether anything changed. Each round is written to the shared folder, so
lineage stays short and lost executors cost one round at most. A hub with very many links
is pre-aggregated before its shuffle, and its join is an ordinary sort-merge join that AQE may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour (itself included)."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them (links have u > v)."""
    lowest = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(lowest, "u")
    return (moved.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(lowest.select("u", F.col("m").alias("v"))).distinct())


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (columns ``u``, ``v``): the smallest node reachable.

    Self-links and links with a null end are ignored; repeated links count once.
    """
    now = stored(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                 .distinct(), "links")
    mark = F.struct(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")))
    before = now.agg(mark).first()[0]
    while before[0]:
        now = stored(_small_star(_large_star(now)), "links")
        after = now.agg(mark).first()[0]
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v"), F.col("v")).distinct())
