"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (smallest node reachable) of every node of ``edges`` (columns ``a``, ``b``).

    Each step only joins and aggregates by node (a node of any degree is pre-aggregated, and
    its edges stay spread), and is written to the shared folder.  It ends when a step changes
    nothing, after a logarithmic number of steps in practice.
    """
    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())

    edges = written(edges.where("a != b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "edges")
    now = mark(edges)
    while now[0]:
        # large star: every larger neighbour of a node is linked to the node's smallest neighbour (or itself)
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select("lo", "hi"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u AND v != m").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        # small star: every smaller neighbour of a node, and the node, are linked to the smallest one
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(low, "hi").where("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                 .union(low.select("hi", F.col("m").alias("lo"))).distinct())
        edges = written(small, "edges")
        before, now = now, mark(edges)
        if now == before:
            break
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
        edges.select("lo", "lo").distinct())
