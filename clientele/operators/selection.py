"""How many clusters: the metrics of each k, the gap statistic and the weighted choice."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clientele.constants import GAP_SETS, K_DEFAULT, K_RANGE_OK, K_WEIGHTS, MAX_CLUSTERS, SEED
from clientele.operators.kmeans import (
    Model,
    Source,
    assign,
    fit_models,
    seed_pools,
    spread,
    starting_models,
)
from clientele.operators.metrics import all_metrics
from clientele.storage import materialize

#: Rows of a block of a uniform set, and expected rows of the draw its centres start from.
UNIFORM_BLOCK = 8_192
UNIFORM_POOL = 4_096
METRICS = ["silhouette", "calinski_harabasz", "davies_bouldin", "wcss"]


@dataclass(frozen=True)
class Uniform:
    """Uniform tables as large as the points; each block of rows is drawn where it is used.

    A block's values follow from the seed, the set and the block's number, so any task that runs
    again draws the same ones, and no copy of the table is stored.
    """

    rows: int
    sets: int
    seed: int
    low: tuple[float, ...]
    high: tuple[float, ...]

    def blocks(self, spark: SparkSession) -> DataFrame:
        """(part, block): parts from 1."""
        each = -(-self.rows // UNIFORM_BLOCK)
        cores = spark.sparkContext.defaultParallelism
        total = each * self.sets
        return spark.range(0, total, 1, max(1, min(total, max(cores, total // 16)))).select(
            (F.col("id") % self.sets + 1).cast("int").alias("part"),
            F.floor(F.col("id") / self.sets).alias("block"),
        )

    def draw(self, part: int, block: int) -> np.ndarray:
        n = min(UNIFORM_BLOCK, self.rows - block * UNIFORM_BLOCK)
        even = np.random.default_rng([self.seed, part, block]).random((n, len(self.low)))
        low, high = np.array(self.low), np.array(self.high)
        return low + (high - low) * even

    def source(self, spark: SparkSession) -> Source:
        def read(batch: pd.DataFrame) -> Iterator[tuple[int, np.ndarray]]:
            for part, block in zip(batch["part"].tolist(), batch["block"].tolist()):
                yield part, self.draw(part, block)

        return self.blocks(spark), read

    def table(self, spark: SparkSession, columns: Sequence[str], share: float = 1.0) -> DataFrame:
        """(part, row, *columns): all rows, or a draw of about a share of all of them."""
        def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for part, block in zip(batch["part"].tolist(), batch["block"].tolist()):
                    data = self.draw(part, block)
                    rng = np.random.default_rng([self.seed, part, block, 1])
                    kept = np.flatnonzero(rng.random(len(data)) < share)
                    out = pd.DataFrame(data[kept], columns=list(columns))
                    out.insert(0, "part", part)
                    out.insert(1, "row", block * UNIFORM_BLOCK + kept)
                    yield out

        fields = ", ".join(f"`{c}` double" for c in columns)
        return self.blocks(spark).mapInPandas(rows, f"part int, row bigint, {fields}")

    def spread(self) -> float:
        """Mean variance of a column."""
        return float(np.mean((np.array(self.high) - np.array(self.low)) ** 2 / 12))


def uniform_like(
    points: DataFrame, columns: Sequence[str], sets: int = GAP_SETS, seed: int = SEED,
    per_column: bool = False,
) -> Uniform:
    """The box runs from the least to the largest value of all columns together, or of each
    column with ``per_column``."""
    ranges = points.agg(
        F.count("*").alias("n"),
        *[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in columns],
    ).first()
    low, high = [ranges[c].lo for c in columns], [ranges[c].hi for c in columns]
    if not per_column:
        low, high = [min(low)] * len(low), [max(high)] * len(high)
    return Uniform(ranges.n, sets, seed, tuple(low), tuple(high))


def reference_sets(
    points: DataFrame, columns: Sequence[str], sets: int = GAP_SETS, seed: int = SEED,
    per_column: bool = False,
) -> DataFrame:
    """``sets`` uniform tables as large as ``points``, numbered from 1 in ``part``."""
    uniform = uniform_like(points, columns, sets, seed, per_column)
    return uniform.table(points.sparkSession, columns)


def fit_every_k(
    points: DataFrame,
    columns: Sequence[str],
    max_k: int = MAX_CLUSTERS,
    seed: int = SEED,
    gap_sets: int = GAP_SETS,
    per_column: bool = False,
) -> dict[tuple[int, int], Model]:
    """The best model of each (part, k): part 0 the points, the others the reference sets.

    All of them are fitted by the same scans.
    """
    columns, spark = list(columns), points.sparkSession
    pools = {0: seed_pools(points, columns, [seed])[0]}
    others, spreads = [], {}
    if gap_sets:
        uniform = uniform_like(points, columns, gap_sets, seed, per_column)
        drawn = uniform.table(spark, columns, min(1.0, UNIFORM_POOL / uniform.rows)).toPandas()
        # Rows of a uniform set are independent: each drawn one stands for equally many.
        pools |= {
            int(part): (rows.sort_values("row")[columns].to_numpy(), np.ones(len(rows)))
            for part, rows in drawn.groupby("part")
        }
        others = [uniform.source(spark)]
        spreads = {part: uniform.spread() for part in range(1, gap_sets + 1)}
    wanted = [
        (part, k, seed + max(part - 1, 0)) for part in pools for k in range(2, max_k + 1)
    ]
    models = starting_models(spark, pools, wanted)
    fitted = fit_models(points, columns, models, others, spreads)
    return {(part, k): model for (part, k, _), model in zip(wanted, fitted, strict=True)}


def _gaps(best: dict[tuple[int, int], Model]) -> dict[int, float]:
    parts = {part for part, _ in best} - {0}
    return {
        k: float(np.log(np.mean([best[p, k].cost for p in parts])) - np.log(best[0, k].cost))
        for part, k in best if part == 0
    }


def gap_statistic(
    points: DataFrame,
    columns: Sequence[str],
    max_k: int = MAX_CLUSTERS,
    seed: int = SEED,
    per_column: bool = False,
) -> DataFrame:
    """Log of the mean cost on uniform data less the log of the cost on the points."""
    best = fit_every_k(points, columns, max_k, seed, per_column=per_column)
    return points.sparkSession.createDataFrame(
        sorted(_gaps(best).items()), "k int, gap_statistic double"
    )


def _quality(points, columns, best, distance: str = "euclidean") -> DataFrame:
    named = {f"k{k}": model for (part, k), model in best.items() if part == 0}
    labeled = materialize(spread(assign(points, columns, named)), "sweep")
    return all_metrics(labeled, columns, list(named), distance=distance).select(
        F.substring("labeling", 2, 9).cast("int").alias("k"),
        # One label left, or none, cannot be told apart from another.
        F.when(F.col("n_clusters") > 1, F.col("silhouette")).otherwise(F.lit(-1.0))
        .alias("silhouette"),
        *METRICS[1:],
    )


def kmeans_sweep(
    points: DataFrame, columns: Sequence[str], max_k: int = MAX_CLUSTERS, seed: int = SEED,
    distance: str = "euclidean",
) -> DataFrame:
    """Silhouette, CH, DB and WCSS of the best k-means model for each k."""
    best = fit_every_k(points, columns, max_k, seed, gap_sets=0)
    return _quality(points, columns, best, distance)


def metrics_of_fits(
    points: DataFrame, columns: Sequence[str], best: dict[tuple[int, int], Model],
    distance: str = "euclidean",
) -> DataFrame:
    """The sweep and the gap statistic of fitted models, stored: one row per k."""
    gaps = points.sparkSession.createDataFrame(
        sorted(_gaps(best).items()), "k int, gap_statistic double"
    )
    return materialize(_quality(points, columns, best, distance).join(gaps, "k"), "k")


def k_metrics(
    points: DataFrame, columns: Sequence[str], max_k: int = MAX_CLUSTERS, seed: int = SEED
) -> DataFrame:
    return metrics_of_fits(points, columns, fit_every_k(points, columns, max_k, seed))


def k_scores(metrics: DataFrame) -> DataFrame:
    """Each metric scaled to 0..1 over all k (Davies-Bouldin turned round) and weighted."""
    every = Window.partitionBy()

    def scaled(name: str) -> Column:
        low, high = F.min(name).over(every), F.max(name).over(every)
        share = (F.col(name) - low) / (high - low + F.lit(1e-10))
        return 1 - share if name == "davies_bouldin" else share

    score = sum((F.lit(w) * scaled(name) for name, w in K_WEIGHTS.items()), F.lit(0.0))
    return metrics.withColumn("score", score)


def consensus_k(metrics: DataFrame) -> DataFrame:
    """The k with the highest score, the least one on a tie."""
    return k_scores(metrics).orderBy(F.desc("score"), "k").limit(1).select("k", "score")


def optimal_k_table(metrics: DataFrame) -> DataFrame:
    """The best k by each metric, by their consensus, and the one used in the end."""
    def top(name: str) -> Column:
        return F.max_by("k", F.struct(F.col(name), -F.col("k")))

    low, high = K_RANGE_OK
    choice = top("score")
    final = F.when(choice.between(low, high), choice).otherwise(F.lit(K_DEFAULT))
    lowest = F.min_by("k", F.struct("davies_bouldin", "k"))
    rows = [
        ("Silhouette", top("silhouette"), F.max("silhouette")),
        ("Calinski-Harabasz", top("calinski_harabasz"), F.max("calinski_harabasz")),
        ("Davies-Bouldin", lowest, F.min("davies_bouldin")),
        ("Gap Statistic", top("gap_statistic"), F.max("gap_statistic")),
        ("Consensus", choice, F.lit(None).cast("double")),
        ("Selected", final, F.lit(None).cast("double")),
    ]
    table = F.array(*[
        F.struct(
            F.lit(name).alias("metric"), k.cast("int").alias("optimal_k"), score.alias("score")
        )
        for name, k, score in rows
    ])
    return k_scores(metrics).agg(table.alias("rows")).select(F.inline("rows"))


def selected_k(metrics: DataFrame) -> int:
    return optimal_k_table(metrics).where(F.col("metric") == "Selected").first().optimal_k
