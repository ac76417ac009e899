"""Robust scaling: distance from the median in units of the interquartile range."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.functions.quantiles import exact_quantiles
from clientele.operators.features import feature_columns


def fit_robust(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Centre and scale of each column; a range of 0 counts as 1."""
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    return {c: (q2, (q3 - q1) or 1.0) for c, (q1, q2, q3) in quartiles.items()}


def robust_scale(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The id and the scaled columns, fitted on the rows of ``df``."""
    columns = columns or feature_columns(df)
    fitted = fit_robust(df, columns)
    return df.select("CustomerID", *[
        ((F.col(c) - center) / scale).alias(c) for c, (center, scale) in fitted.items()
    ])
