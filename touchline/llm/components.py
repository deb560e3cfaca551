"""Connected components of a graph given as edges, by alternating stars; no vertex's neighbours meet in one task.

Each round rewires edges towards the smallest neighbour, in two aggregates that combine on the map side and two joins
whose large keys adaptive execution splits. Edges of each round go to shared storage, so a lost executor costs tasks
of one round. The number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import drop_staged, staged


def connected_components(edges: DataFrame) -> DataFrame:
    """``vertex`` and ``root`` for every vertex but the roots themselves; the root is a component's smallest vertex.

    ``edges`` has the columns ``u`` and ``v`` (numbers). Loops and repeated edges have no effect; no edges, no rows.
    """
    ordered = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    current = staged(ordered, "edges")
    before = None
    while (state := _state(current)) != before:
        before = state
        following = staged(_small_star(_large_star(current)), "edges")
        drop_staged(current)
        current = following
    return current.select(F.col("u").alias("vertex"), F.col("v").alias("root"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a vertex to the smallest of the vertex and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a vertex and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    moved = edges.join(least, "u").where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.unionByName(least.withColumnRenamed("least", "v")).distinct()
