"""Positions in a global order, without a task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.storage import materialize

_PLACES = (1 << 33) - 1


def with_position(df: DataFrame, order: Sequence[Column], name: str, first: int = 0) -> DataFrame:
    """``df``, stored, with each row's place in the order.

    The sort deals ranges to partitions; a row's place is its place in the partition after the
    rows of all earlier ones, whose counts are as few as the partitions.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACES))
    ordered = materialize(
        df.orderBy(*order).withColumn("_part", F.spark_partition_id()).withColumn("_place", place),
        "ordered",
    )
    counts = ordered.groupBy("_part").agg(F.count("*").alias("n")).collect()
    before, offsets = first, []
    for row in sorted(counts, key=lambda r: r["_part"]):
        offsets.append((row["_part"], before))
        before += row["n"]
    starts = df.sparkSession.createDataFrame(offsets or [(0, first)], "_part int, _first bigint")
    return ordered.join(starts, "_part").withColumn(
        name, F.col("_first") + F.col("_place")
    ).drop("_part", "_place", "_first")
