"""Bias-corrected sample moments as aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sample_skewness(name: str) -> Column:
    """Null below three rows, 0 for a constant."""
    n = F.count(name).cast("double")
    corrected = F.coalesce(F.skewness(name), F.lit(0.0)) * F.sqrt(n * (n - 1))
    return F.when(n > 2, F.try_divide(corrected, n - 2))


def sample_kurtosis(name: str) -> Column:
    """Excess kurtosis; null below four rows, 0 for a constant."""
    n = F.count(name).cast("double")
    inner = (n + 1) * F.kurtosis(name) + 6
    corrected = F.try_divide((n - 1) * inner, (n - 2) * (n - 3))
    return F.when(n > 3, F.coalesce(corrected, F.lit(0.0)))


def safe_corr(x: str, y: str) -> Column:
    """Pearson correlation; null when either side is constant."""
    both = F.stddev_pop(x) * F.stddev_pop(y)
    return F.try_divide(F.covar_pop(x, y), both)
