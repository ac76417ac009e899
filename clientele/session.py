"""A session with the settings the operators are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(name: str = "clientele", master: str | None = None, **settings) -> SparkSession:
    """Adaptive execution, skew splitting and Arrow on; anything else through ``settings``."""
    builder = (
        SparkSession.builder.appName(name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
