"""Connected components of an undirected graph by alternating large-star and small-star steps.

Each step is one aggregation (combined on the map side, so a vertex with very many links is no bottleneck) and one
join with its result. The links are stored after each round in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import cut


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a vertex is linked with the least of the vertex and its neighbours."""
    both = _both(edges)
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """A vertex and its smaller neighbours are linked with the least of them. Expects u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """edges: u long, v long. Returns u, v: each vertex with links but the least of its component, and that least.
    Loops and repeated links change nothing; without links the result is empty."""
    now = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = _print(now)
    while seen[0]:
        now = cut(small_star(large_star(now)))
        if (new := _print(now)) == seen:
            break
        seen = new
    return now
