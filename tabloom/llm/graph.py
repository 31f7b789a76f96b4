"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.checkpoints import stage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root`` (the least node of its component) for every node of an edge.

    Alternates two kinds of steps until nothing changes: every node hands its larger
    neighbours, then its smaller ones, over to the least node it knows. Each step only
    joins edges with one row per node, written out before, so that adaptive execution can
    cut a node with very many edges, and the number of edges never grows. Each step is written out, so
    a lost executor costs one step at most.
    """
    known = stage(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(),
        "edges")
    before = None
    while True:
        large = stage(_large_star(known), "star")
        known = stage(_small_star(large), "star")
        # Two numbers that tell whether the set of edges is still the same.
        now = known.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    roots = known.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return known.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))  # u: the node, v: its neighbour
    least = stage(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "least")
    return (both.where("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = stage(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()
