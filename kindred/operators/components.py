"""Connected components of a distributed graph, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.storage import staged


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("_m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's least neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    tied = both.join(_least(both), "u").where("v > u")
    return tied.select(F.col("v").alias("u"), F.least("u", "_m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to the least of them."""
    tied = edges.join(_least(edges), "u")
    moved = tied.where("v <> _m").select(F.col("v").alias("u"), F.col("_m").alias("v"))
    return moved.unionByName(_least(edges).withColumnRenamed("_m", "v")).distinct()


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)``: for every node of an edge the least node it is connected with.

    Large and small stars in turn make every component a star around its least node, in a number
    of rounds that grows with the logarithm of the graph. Each round is written to
    the shared folder. Joins are between shuffled sides, so Spark splits a hub's rows.
    """
    now = staged(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "edges",
    )
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
        if mark == seen or not mark[0]:
            break
        seen = mark
        now = staged(_small_star(_large_star(now)), "edges")
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select("component", "component").distinct().toDF("node", "component"))
