"""Exploratory statistics of the customer features, as tables.

Moments and counts come from one wide aggregation, which sends one partial row per task, and are
turned into one row per feature afterwards; the rows themselves are never multiplied by the
number of features.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.constants import (
    ANALYSIS_FEATURES,
    HISTOGRAM_BINS,
    IMPACT_FEATURES,
    PLOT_SAMPLE,
    SEED,
)
from clientele.functions.moments import safe_corr, sample_kurtosis, sample_skewness
from clientele.functions.quantiles import exact_quantiles

QUARTILES = (0.25, 0.5, 0.75)


def per_feature(
    df: DataFrame, features: Sequence[str], values: Callable[[str], dict[str, Column]]
) -> DataFrame:
    """One aggregation over all features, then a row for each."""
    rows = [
        F.struct(F.lit(f).alias("feature"), *[v.alias(k) for k, v in values(f).items()]).alias(f)
        for f in features
    ]
    return df.agg(*rows).select(F.inline(F.array(*[F.col(f) for f in features])))


def _number(value: float | None) -> Column:
    return F.lit(value).cast("double")


def summary_statistics(df: DataFrame, features: Sequence[str] = ANALYSIS_FEATURES) -> DataFrame:
    quartiles = exact_quantiles(df, features, QUARTILES)
    return per_feature(df, features, lambda f: {
        "count": F.count(f),
        "mean": F.avg(f),
        "std": F.stddev_samp(f),
        "min": F.min(f),
        "q25": _number(quartiles[f][0]),
        "median": _number(quartiles[f][1]),
        "q75": _number(quartiles[f][2]),
        "max": F.max(f),
        "skewness": sample_skewness(f),
        "kurtosis": sample_kurtosis(f),
    })


def feature_histogram(
    df: DataFrame, features: Sequence[str] = ANALYSIS_FEATURES, bins: int = HISTOGRAM_BINS
) -> DataFrame:
    """Counts in equal-width bins, empty ones included, with each feature's centre and skew.

    The last bin includes its right edge; a constant feature gets a range one unit wide.
    """
    medians = exact_quantiles(df, features, [0.5])
    shape = per_feature(df, features, lambda f: {
        "lo": F.min(f), "hi": F.max(f), "mean": F.avg(f), "median": _number(medians[f][0]),
        "skewness": sample_skewness(f),
    }).withColumns({
        "lo": F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")),
        "hi": F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")),
    })
    bounds = {r.feature: (r.lo, r.hi) for r in shape.collect()}

    def bin_of(f: str) -> Column:
        lo, hi = (_number(b) for b in bounds[f])
        place = F.floor((F.col(f) - lo) / (hi - lo) * bins)
        return F.least(place, F.lit(bins - 1)).cast("int")

    marks = F.array(*[
        F.struct(F.lit(f).alias("feature"), bin_of(f).alias("bin")) for f in features
    ])
    counts = df.select(F.inline(marks)).groupBy("feature", "bin").agg(F.count("*").alias("n"))
    every = F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))
    width = (F.col("hi") - F.col("lo")) / bins
    return (
        shape.withColumn("bin", every)
        .join(counts, ["feature", "bin"], "left")
        .select(
            "feature",
            "bin",
            (F.col("lo") + F.col("bin") * width).alias("bin_start"),
            (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_end"),
            F.coalesce("n", F.lit(0)).alias("n"),
            "mean",
            "median",
            "skewness",
        )
    )


def feature_kde(
    df: DataFrame,
    features: Sequence[str] = ANALYSIS_FEATURES,
    grid_points: int = 200,
    cut: float = 0.0,
) -> DataFrame:
    """Gaussian kernel density on an even grid, with Scott's bandwidth.

    The grid runs ``cut`` bandwidths beyond the data on both sides. Each Arrow batch adds its
    rows to the whole grid at once and passes on one row per grid point, so what is shuffled
    depends on the grid and the number of tasks only. A constant feature has no density.
    """
    stats = per_feature(df, features, lambda f: {
        "n": F.count(f), "std": F.stddev_samp(f), "lo": F.min(f), "hi": F.max(f),
    }).collect()
    grids = {}
    for r in stats:
        if r.std:
            width = r.std * r.n ** -0.2
            grid = np.linspace(r.lo - cut * width, r.hi + cut * width, grid_points)
            grids[r.feature] = (grid, width, r.n)

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, (grid, width, n) in grids.items():
                values = batch[name].dropna().to_numpy()
                gaps = (grid[:, None] - values[None, :]) / width
                heights = np.exp(-0.5 * gaps * gaps).sum(axis=1)
                yield pd.DataFrame({
                    "feature": name,
                    "point": np.arange(grid_points),
                    "x": grid,
                    "density": heights / (n * width * np.sqrt(2 * np.pi)),
                })

    partial = df.select(*features).mapInPandas(
        add_up, "feature string, point int, x double, density double"
    )
    return partial.groupBy("feature", "point", "x").agg(F.sum("density").alias("density"))


def correlation_matrix(df: DataFrame, features: Sequence[str] = ANALYSIS_FEATURES) -> DataFrame:
    """Pearson correlations, one row per ordered pair; null where a feature is constant."""
    pairs = [(x, y) for i, x in enumerate(features) for y in features[: i + 1]]
    values = df.agg(*[safe_corr(x, y).alias(f"{x}|{y}") for x, y in pairs])
    cells = [
        (a, b, f"{x}|{y}") for x, y in pairs for a, b in {(x, y), (y, x)}
    ]
    return values.select(F.inline(F.array(*[
        F.struct(
            F.lit(a).alias("feature"), F.lit(b).alias("other"), F.col(f"`{c}`").alias("correlation")
        )
        for a, b, c in cells
    ])))


def iqr_outliers(df: DataFrame, features: Sequence[str] = ANALYSIS_FEATURES) -> DataFrame:
    """Box-plot quartiles, fences and the rows beyond them."""
    quartiles = exact_quantiles(df, features, QUARTILES)

    def values(f: str) -> dict[str, Column]:
        q1, q2, q3 = (_number(q) for q in quartiles[f])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        return {
            "q1": q1, "median": q2, "q3": q3, "iqr": q3 - q1, "low_fence": low,
            "high_fence": high,
            "outliers": F.count_if((F.col(f) < low) | (F.col(f) > high)),
        }

    return per_feature(df, features, values)


def seeded_sample(df: DataFrame, size: int, seed: int = SEED) -> DataFrame:
    """``size`` customers chosen by a seeded digest of the id: the same ones for any layout."""
    ticket = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("CustomerID")))
    return df.orderBy(ticket).limit(size)


def rfm_pair_sample(df: DataFrame, size: int = PLOT_SAMPLE, seed: int = SEED) -> DataFrame:
    return seeded_sample(df.select("CustomerID", "Recency", "Frequency", "Monetary"), size, seed)


def outlier_removal_impact(
    flagged: DataFrame, features: Sequence[str] = IMPACT_FEATURES, flag: str = "is_outlier"
) -> DataFrame:
    """Each feature before and after the flagged rows are removed, from one pass."""
    kept = ~F.col(flag)

    def values(f: str) -> dict[str, Column]:
        stages = {"before": F.col(f), "after": F.when(kept, F.col(f))}
        return {
            f"{name}_{stage}": make(column)
            for stage, column in stages.items()
            for name, make in (
                ("rows", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min),
                ("max", F.max),
            )
        }

    return per_feature(flagged, features, values)
