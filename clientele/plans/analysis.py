"""The whole analysis, from standard transaction lines to named customer segments."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from clientele.constants import (
    ALGORITHM_ORDER,
    CONTAMINATION,
    MAX_CLUSTERS,
    SEED,
)
from clientele.operators import cleaning, clustering, explore, profiles, segments, validation
from clientele.operators.anomaly import inliers, isolation_forest
from clientele.operators.density import dbscan
from clientele.operators.features import engineer_features, feature_columns
from clientele.operators.kmeans import Model, spread
from clientele.operators.metrics import all_metrics, silhouette_samples
from clientele.operators.scaling import robust_scale
from clientele.operators.selection import (
    fit_every_k,
    metrics_of_fits,
    optimal_k_table,
    selected_k,
)
from clientele.storage import materialize


#: Files that the summary names.
DATASET_FILES = 5


@dataclass
class Analysis:
    """Every table of a finished analysis. All are lazy; the larger ones read stored data."""

    raw: DataFrame
    clean: DataFrame
    features: DataFrame
    scored: DataFrame
    points: DataFrame
    columns: list[str]
    k_table: DataFrame
    k: int
    labels: DataFrame
    comparison: DataFrame
    best: str
    customers: DataFrame
    segments: DataFrame
    assigned: DataFrame
    distance: str

    def exploration(self) -> dict[str, DataFrame]:
        return {
            "summary_statistics": explore.summary_statistics(self.features),
            "feature_histogram": explore.feature_histogram(self.features),
            "feature_kde": explore.feature_kde(self.features),
            "correlation_matrix": explore.correlation_matrix(self.features),
            "iqr_outliers": explore.iqr_outliers(self.features),
            "rfm_pair_sample": explore.rfm_pair_sample(self.features),
            "outlier_removal_impact": explore.outlier_removal_impact(self.scored),
        }

    def description(self) -> dict[str, DataFrame]:
        labeled = self.points.join(
            self.customers.select("CustomerID", "cluster"), "CustomerID"
        )
        samples = silhouette_samples(
            labeled, self.columns, ["cluster"], distance=self.distance
        )
        return {
            "anova": validation.anova(self.customers),
            "pca_projection": profiles.pca_projection(self.points, self.columns),
            "feature_profiles": profiles.feature_profiles(self.customers),
            "cluster_distribution": profiles.cluster_distribution(self.customers),
            "rfm_3d_sample": profiles.rfm_3d_sample(self.customers),
            "cluster_profiles": profiles.cluster_profiles(self.customers),
            "silhouette_by_cluster": profiles.silhouette_by_cluster(samples),
        }

    def reports(self) -> dict[str, DataFrame]:
        report = segments.segment_report(self.segments)
        return {
            "segment_report": report,
            "action_plan": segments.action_plan(report),
            "segment_sample": segments.segment_sample(self.assigned),
            "segment_summary": segments.segment_summary(self.assigned),
            "executive_summary": executive_summary(self),
        }


def robust_points(customers: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Scaled rows, stored with one partition per core for the fits that follow."""
    return materialize(spread(robust_scale(customers, columns)), "points")


def fit_all(
    points: DataFrame,
    columns: Sequence[str],
    k: int,
    seed: int = SEED,
    methods: Sequence[str] = ALGORITHM_ORDER,
    model: Model | None = None,
) -> dict[str, DataFrame]:
    """(id, cluster) from each method; the error of one that fails is the caller's.

    ``methods`` names those to fit; ``model`` saves fitting k-means again. The methods run side by
    side: each has many short rounds, and one's tasks use the cores that another leaves idle.
    """
    known = {
        "KMeans": lambda: clustering.kmeans(points, columns, k, seed, model=model),
        "Agglomerative": lambda: clustering.hierarchical(points, columns, k, seed),
        "GaussianMixture": lambda: clustering.gaussian_mixture(
            points, columns, k, seed, model=model
        ),
        "DBSCAN": lambda: dbscan(points, columns),
        "Consensus": lambda: clustering.consensus_clustering(points, columns, k, seed=seed),
    }
    unknown = set(methods) - set(known)
    if unknown:
        raise ValueError(f"no such methods: {sorted(unknown)}")
    return side_by_side(points.sparkSession, {n: f for n, f in known.items() if n in methods})


def side_by_side(spark: SparkSession, work: dict[str, Callable]) -> dict:
    """The result of each function, run in a thread of its own; the first error ends them all."""
    tag, context = f"side-by-side-{uuid.uuid4().hex}", spark.sparkContext

    def tagged(function: Callable):
        context.addJobTag(tag)
        return function()

    with ThreadPoolExecutor(max(1, len(work))) as pool:
        # Wrapped one by one, as each thread needs its own copy of the caller's job properties.
        futures = {
            name: pool.submit(inheritable_thread_target(spark)(tagged), function)
            for name, function in work.items()
        }
        failed, pending = None, set(futures.values())
        while pending:
            # Once one has failed, jobs that the others begin later are cancelled too.
            done, pending = wait(pending, 1 if failed else None, FIRST_COMPLETED)
            failed = failed or next((f.exception() for f in done if f.exception()), None)
            if failed:
                context.cancelJobsWithTag(tag)
        if failed:
            raise failed
    return {name: future.result() for name, future in futures.items()}


def with_labels(points: DataFrame, labeled: dict[str, DataFrame]) -> DataFrame:
    """``points`` with one label column per method: one shuffle for all of them."""
    rows = reduce(
        DataFrame.union,
        [
            t.select("CustomerID", "cluster", F.lit(name).alias("_method"))
            for name, t in labeled.items()
        ],
    )
    wide = rows.groupBy("CustomerID").agg(*[
        F.max(F.when(F.col("_method") == name, F.col("cluster"))).alias(name) for name in labeled
    ])
    return materialize(spread(points.join(wide, "CustomerID")), "labeled")


def algorithm_comparison(
    labeled: DataFrame, columns: Sequence[str], names: Sequence[str],
    distance: str = "euclidean",
) -> DataFrame:
    """Clusters, silhouette, CH, DB and noise of each method, in the order they are tried.

    A labeling with fewer than two clusters gets -1, 0 and 999.
    """
    noise = labeled.agg(*[
        F.struct(
            F.lit(n).alias("labeling"), F.count_if(F.col(n) == -1).alias("n_noise"),
            F.lit(ALGORITHM_ORDER.index(n)).alias("place"),
        ).alias(n)
        for n in names
    ]).select(F.inline(F.array(*names)))
    measured = noise.join(all_metrics(labeled, columns, names, distance=distance), "labeling", "left")
    enough = F.coalesce(F.col("n_clusters"), F.lit(0)) > 1

    def or_else(name: str, value: float):
        return F.when(enough, F.col(name)).otherwise(F.lit(value)).alias(name)

    return measured.select(
        F.col("labeling").alias("algorithm"),
        F.coalesce("n_clusters", F.lit(0)).alias("n_clusters"),
        or_else("silhouette", -1.0),
        or_else("calinski_harabasz", 0.0),
        or_else("davies_bouldin", 999.0),
        "n_noise",
        "place",
    )


def best_algorithm(comparison: DataFrame) -> DataFrame:
    """The highest silhouette; on a tie the method that is tried first."""
    return comparison.orderBy(F.desc("silhouette"), "place").limit(1).select(
        "algorithm", "silhouette", "n_clusters"
    )


def executive_summary(result: Analysis) -> DataFrame:
    """Key figures as text, one row each."""
    stats = cleaning.clean_stats(result.raw, result.clean).first()
    top = best_algorithm(result.comparison).first()
    tested = result.comparison.count()
    removed = result.scored.where("is_outlier").count()
    # ---- Fixed values: bounds and names of the grades, names of the items ----
    quality = (
        "Good" if top.silhouette > 0.5 else "Moderate" if top.silhouette > 0.3 else "Poor"
    )
    files = sorted({path.rstrip("/").rsplit("/", 1)[-1] for path in result.raw.inputFiles()})
    rows = [
        ("Dataset", ", ".join(files[:DATASET_FILES]) or "none"),
        ("Total Customers", f"{stats.clean_customers:,}"),
        ("Total Transactions", f"{stats.clean_rows:,}"),
        ("Transaction Retention", f"{stats.transaction_retention_rate or 0:.1f}%"),
        ("Customer Retention", f"{stats.customer_retention_rate or 0:.1f}%"),
        ("Best Algorithm", top.algorithm),
        ("Optimal Clusters", f"{top.n_clusters}"),
        ("Silhouette Score", f"{top.silhouette:.4f}"),
        ("Cluster Quality", quality),
        ("Features Used", f"{len(result.columns)}"),
        ("Algorithms Tested", f"{tested}"),
        ("Outliers Removed", f"{removed:,}"),
    ]
    return result.clean.sparkSession.createDataFrame(rows, "item string, value string")


def run_analysis(
    lines: DataFrame,
    max_clusters: int = MAX_CLUSTERS,
    log_mode: str = "auto",
    contamination: float = CONTAMINATION,
    seed: int = SEED,
    methods: Sequence[str] = ALGORITHM_ORDER,
    distance: str = "euclidean",
    order_col: str | None = None,
) -> Analysis:
    """Clean, engineer, drop anomalies, scale, choose k, cluster, name the segments.

    ``lines`` are standard lines, as ``read_lines`` gives them. ``methods`` names the clustering
    methods to try, ``distance`` the silhouette that chooses among k and methods: exact
    ``euclidean`` ones are quadratic in the customers, ``squared`` ones linear.
    """
    clean = cleaning.clean_lines(lines, order_col=order_col)
    features = materialize(engineer_features(clean, log_mode, order_col), "features")
    columns = feature_columns(features)
    scored = isolation_forest(features, columns, contamination, seed=seed)
    kept = inliers(scored)
    points = robust_points(kept, columns)

    fitted = fit_every_k(points, columns, max_clusters, seed)
    k_table = metrics_of_fits(points, columns, fitted, distance)
    k = selected_k(k_table)

    labeled = fit_all(points, columns, k, seed, methods, fitted.get((0, k)))
    wide = with_labels(points, labeled)
    comparison = materialize(algorithm_comparison(wide, columns, list(labeled), distance), "comparison")
    best = best_algorithm(comparison).first().algorithm

    labels = wide.select("CustomerID", *labeled)
    customers = materialize(
        kept.join(labels.select("CustomerID", F.col(best).alias("cluster")), "CustomerID"),
        "clustered",
    )
    named = materialize(segments.interpret_clusters(customers), "segments")
    return Analysis(
        raw=lines, clean=clean, features=features, scored=scored, points=points, columns=columns,
        k_table=optimal_k_table(k_table), k=k, labels=labels, comparison=comparison, best=best,
        customers=customers, segments=named, distance=distance,
        assigned=segments.assign_segments(customers, named),
    )
