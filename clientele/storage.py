"""Intermediate tables in the cluster's shared folder.

A table that several later jobs read is written once as Parquet under ``spark.checkpoint.dir``.
That cuts its lineage, survives the loss of executors, and lets each later scan read only the
columns and row groups it needs.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="clientele-"))
    return context.getCheckpointDir()


#: Paths handed out inside each open ``dropping_tables`` block, the innermost last.
_handed_out: list[list[str]] = []


def new_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    for paths in _handed_out:
        paths.append(path)
    return path


@contextmanager
def dropping_tables(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end, every table that was stored inside the block.

    Results are lazy and read stored tables, so write or collect them before the block ends.
    """
    paths: list[str] = []
    _handed_out.append(paths)
    try:
        yield
    finally:
        _handed_out.remove(paths)
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in paths:
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the table read from there."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
