"""Connected components of a link table, by alternating star contraction.

Each step replaces links by links to the smallest neighbour, for all larger and
then all smaller neighbours, until every node points at the smallest id of its
component.  Steps are aggregations and joins over written tables; nothing is
collected, and hub nodes combine on the map side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.plans.joins import materialise


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.where("v > u").join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct())


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(u, v)`` that is not the
    smallest of its component.  No links give no rows."""
    edges = materialise(links.where("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    while True:
        after = materialise(_small_star(_large_star(edges)), "links")
        # Converged: every node has one link and no link target has one itself.
        state = after.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
        chained = after.join(after.select(F.col("u").alias("v")), "v", "left_semi").limit(1).count()
        if chained == 0 and state.where("n > 1").limit(1).count() == 0:
            return after.select(F.col("u").alias("node"), F.col("v").alias("component"))
        edges = after
