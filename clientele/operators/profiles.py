"""What the clusters look like. Noise (-1) takes no part."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clientele.constants import ANALYSIS_FEATURES, PLOT_SAMPLE, PROFILE_FEATURES, SEED
from clientele.operators.explore import seeded_sample
from clientele.operators.validation import filter_noise


def fit_pca(
    points: DataFrame, columns: Sequence[str], components: int = 2
) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """Column means, loadings (largest one positive) and explained shares of variance."""
    assembled = VectorAssembler(inputCols=list(columns), outputCol="_raw").transform(points)
    center = StandardScaler(
        withMean=True, withStd=False, inputCol="_raw", outputCol="_centered"
    ).fit(assembled)
    model = PCA(k=components, inputCol="_centered", outputCol="_out").fit(
        center.transform(assembled)
    )
    loadings = model.pc.toArray()
    largest = loadings[np.abs(loadings).argmax(axis=0), np.arange(components)]
    loadings = loadings * np.where(largest < 0, -1.0, 1.0)
    return center.mean.toArray(), loadings, list(model.explainedVariance.toArray())


def pca_projection(points: DataFrame, columns: Sequence[str], components: int = 2) -> DataFrame:
    """The id and the first principal components, as plain column arithmetic."""
    means, loadings, _ = fit_pca(points, columns, components)

    def component(i: int) -> Column:
        return sum(
            (
                (F.col(c) - F.lit(float(m))) * F.lit(float(w))
                for c, m, w in zip(columns, means, loadings[:, i])
            ),
            F.lit(0.0),
        )

    return points.select("CustomerID", *[
        component(i).alias(f"pc{i + 1}") for i in range(components)
    ])


def pca_variance(points: DataFrame, columns: Sequence[str], components: int = 2) -> DataFrame:
    shares = fit_pca(points, columns, components)[2]
    return points.sparkSession.createDataFrame(
        [(f"pc{i + 1}", float(s)) for i, s in enumerate(shares)],
        "component string, explained_variance double",
    )


def feature_profiles(
    df: DataFrame, label: str = "cluster", features: Sequence[str] = ANALYSIS_FEATURES
) -> DataFrame:
    """Mean of each feature per cluster, on a scale of 0 to 1 over all rows."""
    per_cluster = filter_noise(df, label).groupBy(F.col(label).alias("cluster")).agg(*[
        make(f).alias(f"{name}_{f}")
        for f in features for name, make in (("avg", F.avg), ("lo", F.min), ("hi", F.max))
    ])
    # Scaling is linear, so the mean of scaled values is the scaled mean.
    every = Window.partitionBy()

    def scaled(f: str) -> Column:
        low, high = F.min(f"lo_{f}").over(every), F.max(f"hi_{f}").over(every)
        return F.try_divide(F.col(f"avg_{f}") - low, high - low)

    return per_cluster.select("cluster", *[scaled(f).alias(f) for f in features])


def cluster_distribution(df: DataFrame, label: str = "cluster") -> DataFrame:
    counts = filter_noise(df, label).groupBy(F.col(label).alias("cluster")).agg(
        F.count("*").alias("customers")
    )
    share = F.col("customers") * 100 / F.sum("customers").over(Window.partitionBy())
    return counts.withColumn("percentage", share).orderBy(F.desc("customers"), "cluster")


def cluster_profiles(
    df: DataFrame, label: str = "cluster", features: Sequence[str] = PROFILE_FEATURES
) -> DataFrame:
    return (
        filter_noise(df, label)
        .groupBy(F.col(label).alias("cluster"))
        .agg(
            F.count("CustomerID").alias("customers"),
            *[
                make(f).alias(f"{f}_{name}")
                for f in features for name, make in (("mean", F.avg), ("std", F.stddev_samp))
            ],
        )
        .orderBy("cluster")
    )


def rfm_3d_sample(
    df: DataFrame, label: str = "cluster", size: int = PLOT_SAMPLE, seed: int = SEED
) -> DataFrame:
    kept = df.select(
        "CustomerID", "Recency", "Frequency", "Monetary", F.col(label).alias("cluster")
    )
    return filter_noise(seeded_sample(kept, size, seed))


def silhouette_by_cluster(samples: DataFrame) -> DataFrame:
    """Size, mean, least and largest silhouette of each cluster and, last, of all rows."""
    overall = F.col("cluster") == "Overall"
    mean = F.col("avg_silhouette")
    rated = samples.rollup("cluster").agg(
        F.grouping("cluster").alias("_all"),
        F.count("*").alias("size"),
        F.avg("silhouette").alias("avg_silhouette"),
        F.min("silhouette").alias("min_silhouette"),
        F.max("silhouette").alias("max_silhouette"),
    )
    named = F.when(F.col("_all") == 1, F.lit("Overall")).otherwise(
        F.concat(F.lit("Cluster "), F.col("cluster").cast("string"))
    )
    # ---- Fixed values: bounds and names of the grades ----
    quality = (
        F.when(overall & (mean >= 0.3), F.lit("Average"))
        .when(overall, F.lit("Poor"))
        .when(mean >= 0.5, F.lit("Good"))
        .when(mean >= 0.3, F.lit("Fair"))
        .otherwise(F.lit("Poor"))
    )
    return rated.withColumn("cluster", named).drop("_all").withColumn("quality", quality)
