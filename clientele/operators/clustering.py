"""The clustering methods. Each takes scaled points and gives (id, cluster)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.constants import CONSENSUS_RUNS, SEED, STARTS
from clientele.functions.agglomerate import BLOCK_UNITS, CoAssociation, Ward, agglomerate_table
from clientele.functions.labels import renumber
from clientele.operators.kmeans import (
    Model,
    assign,
    fit_kmeans,
    fit_models,
    seed_pools,
    starting_models,
)
from clientele.operators.mixture import assign_mixture, fit_mixture
from clientele.storage import materialize


def kmeans(
    points: DataFrame,
    columns: Sequence[str],
    k: int,
    seed: int = SEED,
    starts: int = STARTS,
    model: Model | None = None,
) -> DataFrame:
    """The best of several starts, or the labels of a model that is already fitted."""
    model = model or fit_kmeans(points, columns, k, seed, starts)
    return renumber(assign(points, columns, {"label": model}), "label")


def hierarchical(
    points: DataFrame,
    columns: Sequence[str],
    k: int,
    seed: int = SEED,
    small_clusters: int | None = None,
    block_units: int = BLOCK_UNITS,
) -> DataFrame:
    """Ward linkage.

    Every distinct row is a unit, whatever their number, and equal rows are one unit with their
    number as weight, since they merge first anyway. With ``small_clusters``, k-means first forms
    so many clusters, whose sizes and centres are the weighted units; every row follows its small
    cluster. That is another, linear method, and only the caller chooses it.
    """
    columns = list(columns)
    if small_clusters is None:
        units = materialize(points.groupBy(*columns).agg(
            F.max(F.col("CustomerID").cast("string")).alias("unit"),
            F.count("*").cast("double").alias("weight"),
        ), "units")
        members = points.select("CustomerID", *columns).join(
            units.select("unit", *columns), columns
        )
    else:
        vectors = VectorAssembler(inputCols=columns, outputCol="_vector").transform(points)
        fitted = KMeans(
            k=small_clusters, featuresCol="_vector", predictionCol="unit", seed=seed
        ).fit(vectors)
        members = materialize(
            fitted.transform(vectors).select("CustomerID", F.col("unit").cast("string"), *columns),
            "members",
        )
        units = members.groupBy("unit").agg(
            F.count("*").cast("double").alias("weight"), *[F.avg(c).alias(c) for c in columns]
        )
    labels = agglomerate_table(units, columns, k, Ward(), block_units)
    return renumber(members.select("CustomerID", "unit").join(labels, "unit"), "label")


def gaussian_mixture(
    points: DataFrame, columns: Sequence[str], k: int, seed: int = SEED, starts: int = STARTS,
    model: Model | None = None,
) -> DataFrame:
    """Full covariances, started from the clusters of k-means; see ``fit_mixture``."""
    model = model or fit_kmeans(points, columns, k, seed, starts)
    return renumber(assign_mixture(points, columns, fit_mixture(points, columns, model)), "label")


def kmeans_runs(
    points: DataFrame,
    columns: Sequence[str],
    k: int,
    runs: int = CONSENSUS_RUNS,
    seed: int = SEED,
    starts: int = STARTS,
) -> DataFrame:
    """(id, signature): each row's labels in ``runs`` fits with successive seeds."""
    # Each run draws its own candidates, so the runs are independent.
    pools = dict(enumerate(seed_pools(points, columns, [seed + run for run in range(runs)])))
    wanted = [(run, k, seed + run) for run in range(runs)]
    begun = starting_models(points.sparkSession, pools, wanted, starts)
    for model in begun:
        model.part = 0
    best = {f"run{run}": model for run, model in enumerate(fit_models(points, columns, begun))}
    labeled = assign(points, columns, best)
    return labeled.select("CustomerID", F.array(*best).alias("signature"))


def coassociation(one: str, other: str):
    """The share of runs in which two signatures agree, as a column."""
    agree = F.aggregate(
        F.zip_with(one, other, lambda a, b: (a == b).cast("int")), F.lit(0), lambda s, x: s + x
    )
    return F.try_divide(agree, F.size(one))


def link_signatures(
    signed: DataFrame, k: int, runs: int, labels: int, id_col: str = "CustomerID",
    block_units: int = BLOCK_UNITS,
) -> DataFrame:
    """Average linkage of rows (id, signature) on the share of runs in which they differ.

    A signature holds ``runs`` labels from 0 to ``labels`` - 1. Rows with equal ones are at
    distance 0, so only the distinct signatures are linked, weighted by their rows.
    """
    # The signature as text orders and hashes like any other unit name.
    unit = F.array_join(F.col("signature").cast("array<string>"), "-")
    named = signed.withColumn("unit", unit)
    shares = {
        f"r{run}_{c}": (F.col("signature")[run] == c).cast("double")
        for run in range(runs) for c in range(labels)
    }
    units = materialize(named.groupBy("unit").agg(
        F.count("*").cast("double").alias("weight"), F.first("signature").alias("signature")
    ).select("unit", "weight", *[v.alias(n) for n, v in shares.items()]), "signed")
    linked = agglomerate_table(units, list(shares), k, CoAssociation(runs), block_units)
    return renumber(named.select(id_col, "unit").join(linked, "unit"), "label", id_col)


def consensus_clustering(
    points: DataFrame,
    columns: Sequence[str],
    k: int,
    runs: int = CONSENSUS_RUNS,
    seed: int = SEED,
    block_units: int = BLOCK_UNITS,
) -> DataFrame:
    """Average linkage on how seldom two rows share a label over repeated k-means runs."""
    signed = materialize(kmeans_runs(points, columns, k, runs, seed), "signatures")
    return link_signatures(signed, k, runs, k, block_units=block_units)
