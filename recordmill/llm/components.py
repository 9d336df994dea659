"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordmill.llm.common import written


def stars(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: neighbours above a node go to the least of its neighbourhood. Small star: the
    node and its neighbours below it go to the least of these."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not large:
        both = both.where("v < u")
    # a table: else the join would take over the grouping's partitions and could not split any
    least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    # the join splits a node with very many neighbours, the grouping adds them up before it shuffles
    moved = both.join(least, "u")
    moved = moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) if large else moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges u, v (long) -> node, root: the least node of each component, for every node of an edge.
    Each round is a written table; the number of rounds grows with the logarithm of a path's length."""
    now = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    seen = None
    while True:
        now = written(stars(stars(now, True), False), "edges")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
