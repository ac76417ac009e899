"""One-way analysis of variance of each feature over the clusters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clientele.constants import (
    ANALYSIS_FEATURES,
    EFFECT_FLOOR,
    EFFECT_SIZES,
    SEPARATION,
    SEPARATION_FLOOR,
    SIGNIFICANCE,
)
from clientele.functions.fdist import f_tail


def filter_noise(df: DataFrame, label: str = "cluster") -> DataFrame:
    return df.where(F.col(label) != -1)


def graded(value: Column, grades: Sequence[tuple[float, str]], floor: str) -> Column:
    """The name of the first grade that the value reaches."""
    named = F
    for least, name in grades:
        named = named.when(value >= least, F.lit(name))
    return named.otherwise(F.lit(floor))


def anova(
    df: DataFrame, label: str = "cluster", features: Sequence[str] = ANALYSIS_FEATURES
) -> DataFrame:
    """F, p and the share of variance explained, per feature.

    One grouping by cluster gives sizes, means and inner variances; all else is computed on the
    (clusters x features) rows of that table.
    """
    per_cluster = filter_noise(df, label).groupBy(label).agg(*[
        F.struct(
            F.lit(f).alias("feature"), F.count(f).alias("n"), F.avg(f).alias("mean"),
            (F.var_pop(f) * F.count(f)).alias("within"),
        ).alias(f)
        for f in features
    ])
    own = Window.partitionBy("feature")
    grand = F.sum(F.col("n") * F.col("mean")).over(own) / F.sum("n").over(own)
    sums = (
        per_cluster.select(F.inline(F.array(*features)))
        .withColumn("off", F.col("mean") - grand)
        .groupBy("feature")
        .agg(
            F.sum(F.col("n") * F.col("off") * F.col("off")).alias("between"),
            F.sum("within").alias("within"),
            (F.count("*") - 1).alias("d1"),
            (F.sum("n") - F.count("*")).alias("d2"),
        )
    )
    # A split without any inner variance is beyond every bound.
    perfect = (F.col("within") == 0) & (F.col("between") > 0) & (F.col("d2") > 0)
    ratio = F.when(perfect, F.lit(float("inf"))).otherwise(
        F.try_divide(F.col("between") * F.col("d2"), F.col("within") * F.col("d1"))
    )
    explained = F.coalesce(
        F.try_divide(F.col("between"), F.col("between") + F.col("within")), F.lit(0.0)
    )
    tested = sums.select(
        "feature", ratio.alias("f_statistic"), explained.alias("eta_squared"), "d1", "d2"
    ).withColumn(
        "p_value",
        F.when(F.col("f_statistic") == float("inf"), F.lit(0.0)).otherwise(
            f_tail(F.col("f_statistic"), F.col("d1"), F.col("d2"))
        ),
    )
    return tested.select(
        "feature",
        "f_statistic",
        "p_value",
        "eta_squared",
        F.coalesce(F.col("p_value") < SIGNIFICANCE, F.lit(False)).alias("significant"),
        graded(F.col("eta_squared"), EFFECT_SIZES, EFFECT_FLOOR).alias("effect_size"),
    )


def anova_summary(tests: DataFrame) -> DataFrame:
    """Significant features, mean effect (of effects rounded to three places) and its grade."""
    mean = F.avg(F.round("eta_squared", 3))
    return tests.agg(
        F.count_if("significant").alias("significant_features"),
        F.count("*").alias("features"),
        mean.alias("mean_eta_squared"),
        graded(mean, SEPARATION, SEPARATION_FLOOR).alias("separation"),
    ).where(F.col("features") > 0)
