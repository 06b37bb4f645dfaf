"""Connected components of a link table by alternating large-star and small-star rounds (union-find for tables).

Every round re-hangs each vertex below the smallest vertex it can see; the rounds needed grow with the logarithm of the
longest chain.  Minima are partial aggregates and the joins are plain equi-joins, so a vertex with very many links is
split like any skewed join key.  Rounds are stored tables, so lost executors re-read them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelyard.llm.common import store


def _hang(pairs: DataFrame, keep_own: bool) -> DataFrame:
    """Below each ``u``'s smallest neighbour: its larger neighbours (large star) or it and its smaller ones."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    if not keep_own:  # pairs hold both directions: u itself may be the smallest
        least = least.select("u", F.least("u", "m").alias("m"))
        return pairs.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
    hung = pairs.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(id, component)`` of every vertex of ``links(a, b)``; the component is its smallest vertex.

    An empty link table gives an empty result; self links and repeated links are harmless.
    """
    edges = store(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        edges = store(_hang(_hang(both, keep_own=False), keep_own=True))
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    return edges.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("id"), "component").unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
