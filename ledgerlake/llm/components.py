"""Connected components of an edge table, by alternating large-star and small-star rounds.

Every round is two aggregates and two joins; hot nodes are summed before the shuffle and split by
adaptive execution in the joins. Rounds are cut with written tables, and end when all components
are stars around their smallest nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.blocks import release, stored


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller node and no larger one, or only larger ones."""
    up, down = F.col("u") > F.col("v"), F.struct(F.col("u").alias("node"), F.lit(1).alias("own"), F.lit(0).alias("others"))
    both = edges.select(F.inline(F.array(down, F.struct(F.col("v").alias("node"), F.lit(0).alias("own"), F.lit(1).alias("others")))))
    if edges.where(~up).head(1):
        return False
    nodes = both.groupBy("node").agg(F.sum("own").alias("own"), F.max("others").alias("others"))
    return not nodes.where("own + others > 1").head(1)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def roots(edges: DataFrame) -> DataFrame:
    """(u, v) for every node of ``edges`` but the smallest of its component, which is v."""
    edges = stored(edges.where(F.col("u") != F.col("v")).distinct(), "edges")
    while not _are_stars(edges):
        last, edges = edges, stored(_small_star(_large_star(edges)), "edges")
        release(last)
    return edges
