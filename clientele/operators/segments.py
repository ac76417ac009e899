"""From clusters to named customer segments, and the reports on them.

Everything is computed on one row per cluster, except the assignment of segments to customers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clientele.constants import (
    CHAMPION_SCORE,
    MEANS_FEATURES,
    REPORT_SAMPLE,
    SCORE_WEIGHTS,
    SEED,
    SEGMENTS,
    YEAR_DAYS,
)
from clientele.operators.explore import seeded_sample
from clientele.operators.validation import filter_noise

OVERALL = ["Recency", "Frequency", "Monetary"]


def cluster_means(df: DataFrame, label: str = "cluster") -> DataFrame:
    """Means and size of each cluster, and the means over all its rows together."""
    per_cluster = filter_noise(df, label).groupBy(F.col(label).alias("cluster")).agg(
        F.count("CustomerID").alias("customers"),
        *[F.avg(f).alias(f) for f in MEANS_FEATURES],
    )
    every = Window.partitionBy()
    total = F.sum("customers").over(every)
    return per_cluster.withColumns({
        f"Overall_{f}": F.sum(F.col(f) * F.col("customers")).over(every) / total for f in OVERALL
    })


def value_score(means: DataFrame) -> DataFrame:
    """0..1 from recency within a year and from frequency and spending against the best."""
    every = Window.partitionBy()
    recency, frequency, monetary = SCORE_WEIGHTS

    def against_best(name: str) -> Column:
        share = F.try_divide(F.col(name), F.max(name).over(every))
        return F.least(F.coalesce(share, F.lit(0.0)), F.lit(1.0))

    recent = 1 - F.least(F.col("Recency") / YEAR_DAYS, F.lit(1.0))
    score = (
        recency * recent + frequency * against_best("Frequency")
        + monetary * against_best("Monetary")
    )
    return means.withColumn("value_score", score)


def segment_rules(scored: DataFrame) -> DataFrame:
    """The first segment whose condition a cluster meets, with its texts and priority."""
    recent = F.col("Recency") < F.col("Overall_Recency")
    conditions = {
        "champions": F.col("value_score") > CHAMPION_SCORE,
        "potential": recent & (F.col("Monetary") > F.col("Overall_Monetary")),
        "loyal": F.col("Frequency") > F.col("Overall_Frequency"),
        "new": recent,
        "risk": F.col("Recency") > YEAR_DAYS,
        "standard": F.lit(True),
    }

    def described(key: str) -> Column:
        names = ("priority", "segment_name", "description", "strategy")
        return F.struct(*[F.lit(v).alias(n) for n, v in zip(names, SEGMENTS[key])])

    # Only a condition that holds gives a description, and the first of them counts.
    chosen = F.coalesce(*[F.when(met, described(key)) for key, met in conditions.items()])
    return scored.withColumn("_segment", chosen).select("*", "_segment.*").drop("_segment")


def segment_report(named: DataFrame) -> DataFrame:
    """One row per cluster with its segment, size and share of all clustered customers."""
    share = F.col("customers") * 100 / F.sum("customers").over(Window.partitionBy())
    return named.select(
        "cluster",
        "segment_name",
        "description",
        "strategy",
        "priority",
        "value_score",
        "customers",
        share.alias("percentage"),
        F.col("Recency").alias("avg_recency"),
        F.col("Frequency").alias("avg_frequency"),
        F.col("Monetary").alias("avg_monetary"),
    ).orderBy("cluster")


def interpret_clusters(df: DataFrame, label: str = "cluster") -> DataFrame:
    return cluster_means(df, label).transform(value_score).transform(segment_rules)


def assign_segments(df: DataFrame, named: DataFrame, label: str = "cluster") -> DataFrame:
    """Every customer with the segment of its cluster; noise has none."""
    names = named.select(F.col("cluster").alias(label), F.col("segment_name").alias("segment"))
    return df.join(names, label, "left")


def action_plan(report: DataFrame) -> DataFrame:
    return report.select(
        "priority", "cluster", F.col("segment_name").alias("segment"),
        F.col("customers").alias("size"), "strategy",
    ).orderBy("priority", "cluster")


def segment_sample(
    assigned: DataFrame, label: str = "cluster", size: int = REPORT_SAMPLE, seed: int = SEED
) -> DataFrame:
    kept = assigned.select(
        "CustomerID", "Recency", "Frequency", "Monetary", F.col(label).alias("cluster"), "segment"
    )
    return seeded_sample(kept, size, seed)


def segment_summary(assigned: DataFrame) -> DataFrame:
    """Customers per segment name; the share is of all customers, noise included."""
    counts = assigned.groupBy("segment").agg(F.count("*").alias("customers"))
    share = F.col("customers") * 100 / F.sum("customers").over(Window.partitionBy())
    return (
        counts.withColumn("percentage", share)
        .where(F.col("segment").isNotNull())
        .orderBy(F.desc("customers"), "segment")
    )
