"""Connected components of a table of links, by alternating large and small stars.

Each round is two groupings with map-side minima and two joins; a hub's rows are split by skew joins. Every round is
written to shared storage, so that the plan stays short and a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.store import saved


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _stars(links: DataFrame) -> bool:
    """Whether every node has one link, to a node that has none: then that is its component."""
    ends = (links.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
            .unionByName(links.select("v", F.lit(0), F.lit(1)).toDF("node", "up", "down")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter(
        "up > 1 or up = 1 and down = 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """links (a, b) to (node, component): the least node that each node reaches. Least nodes themselves have no row.

    Self-links, repeated links and either direction are allowed. Links of null are left out.
    """
    links = saved(links.filter("a is not null and b is not null and a != b")
                  .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while not _stars(links):
        links = saved(_small_star(_large_star(links)), "links")
    return links.select(F.col("u").alias("node"), F.col("v").alias("component"))
