"""Connected components by alternating star contractions.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014): each round links every
vertex to the least vertex it has met, which halves long chains, so a few rounds suffice. Each
round's edges are stored in the shared folder, which keeps the plan short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.storage import materialize


#: Parts in which the partitions' minima of a vertex meet first.
PARTS = 16


def _least_neighbor(edges: DataFrame) -> DataFrame:
    """The least neighbour of each vertex, itself included.

    Every partition sends one minimum of a vertex that all of them hold, so those of a hub meet in
    parts before they meet in one task.
    """
    part = F.pmod(F.spark_partition_id(), F.lit(PARTS))
    parts = edges.groupBy("u", part.alias("part")).agg(F.min("v").alias("v"))
    return parts.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a vertex moves to the least one of its neighbourhood."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = both.join(_least_neighbor(both), "u")
    return joined.where(F.col("v") > F.col("u")).select(
        F.col("v").alias("u"), F.col("least").alias("v")
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A vertex and its smaller neighbours all move to the least of them."""
    down = edges.select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    ).where(F.col("u") != F.col("v"))
    least = _least_neighbor(down)
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.union(least.select("u", F.col("least").alias("v"))).where(
        F.col("u") != F.col("v")
    )


def _all_stars(edges: DataFrame) -> bool:
    """Whether every vertex points to one centre and no centre points anywhere."""
    sizes = edges.agg(F.count("*").alias("edges"), F.count_distinct("u").alias("points")).first()
    if sizes.edges != sizes.points:
        return False
    ends = edges.select(F.col("v").alias("u"))
    return edges.join(ends, "u", "left_semi").isEmpty()


def connected_components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """(vertex, component) of every vertex with an edge; the component is its least vertex."""
    current = materialize(
        edges.select(F.col(src).alias("u"), F.col(dst).alias("v"))
        .where(F.col("u") != F.col("v")).distinct(),
        "edges",
    )
    while not _all_stars(current):
        current = materialize(_small_star(_large_star(current)).distinct(), "edges")
    roots = current.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("vertex"), F.col("v").alias("component")).union(roots)
