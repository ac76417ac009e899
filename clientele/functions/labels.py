"""Cluster numbers that do not depend on the run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.functions.ranks import with_position
from clientele.storage import materialize


def renumber(
    labeled: DataFrame, label: str, id_col: str = "CustomerID", first: int = 1
) -> DataFrame:
    """(id, cluster): numbered by falling size, then by least id; a null label becomes -1."""
    stored = materialize(labeled.select(id_col, label), "labels")
    sizes = stored.where(F.col(label).isNotNull()).groupBy(label).agg(
        F.count("*").alias("rows"), F.min(id_col).alias("least")
    )
    placed = with_position(sizes, [F.desc("rows"), F.asc("least")], "cluster", first)
    # Stored, so that the join knows how small it is.
    numbers = materialize(placed.select(label, F.col("cluster").cast("int")), "numbers")
    return stored.join(numbers, label, "left").select(
        id_col, F.coalesce("cluster", F.lit(-1)).alias("cluster")
    )
