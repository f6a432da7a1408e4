"""Connected components by alternating stars.

Each round rewrites the edges so that every node points at the smallest
neighbour; the number of rounds grows with the logarithm of the longest chain.
Minima are aggregated before the shuffle and joined back, so that a node with a
third of all edges is no single task's work.  Rounds are stored in the shared
folder.  Partitions are sized by the number of edges: a round over few edges is
not cut into as many tasks as the session's other shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


#: Edges per partition of a round, and the least number of partitions.
PART_EDGES, LEAST_PARTS = 50_000, 8


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``node``, ``root`` for every node of ``edges (a, b)``: the smallest node it is connected with.

    Nulls and loops are no edges.  Without edges the result has no rows.
    """
    larger, smaller = F.greatest("a", "b"), F.least("a", "b")
    now = edges.filter("a <> b").select(larger.alias("a"), smaller.alias("b")).distinct()
    now, before = stored(now, label), None
    while (mark := _mark(now)) != before:
        parts = max(LEAST_PARTS, mark[0] // PART_EDGES)
        now, before = stored(_small_star(_large_star(now, parts), parts), label), mark
    roots = now.select("b").distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        roots.select(F.col("b").alias("node"), F.col("b").alias("root"))
    )


def _mark(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_000_007), F.sum(F.hash("a", "b").cast("long"))).first()
    )


def _large_star(edges: DataFrame, parts: int) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
    up = both.filter("b > a").join(least.coalesce(parts), F.col("a") == F.col("n"))
    return up.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").coalesce(parts).distinct().coalesce(parts)


def _small_star(edges: DataFrame, parts: int) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m")).coalesce(parts)
    joined = edges.join(least.withColumnRenamed("a", "n"), F.col("a") == F.col("n"))
    moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").coalesce(parts)
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct().coalesce(parts)
