"""Connected components of a link table, by alternating large-star and small-star steps.

(Kiveris et al., "Connected components in MapReduce and beyond", 2014.) Every
step is an aggregate and an equi-join; minima merge before the shuffle and
hot nodes' join partitions can be split. Each round's links are written to
the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.llm.common import keep


def _stars(links: DataFrame) -> bool:
    """Is every node either a centre or linked to one centre only?"""
    up = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = up.unionByName(links.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up > 1 OR (up > 0 AND down > 0)").isEmpty()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a link.

    ``edges`` has columns a and b; loops and repeats are ignored; null ends drop the row.
    """
    now = keep(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    for _ in range(most_rounds):
        if _stars(now):
            break
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        now = keep(small.where("a <> b").distinct(), "links")
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
