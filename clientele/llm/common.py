"""Helpers the operators of this package share.

Words are the runs of bytes other than the six ASCII white-space bytes, which is what
``bytes.split()`` splits on. Texts therefore travel to Python as binary columns.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.storage import materialize, new_path, shared_folder  # noqa: F401

#: Bytes of text that one block of documents holds at least, unless its partition ends.
BLOCK_BYTES = 8 << 20
#: Stands for a null document id, which sorts after every other id.
NO_ID = (1 << 63) - 1

GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def kept_in_worker(make):
    """``make()`` called once in a Python worker, however many tasks it runs.

    Functions reach the workers by value, so what a module holds does not outlive a task there.
    """
    name = f"{make.__module__}.{make.__qualname__}"

    def held():
        kept = sys.modules.setdefault("_kept_in_worker", types.ModuleType("_kept_in_worker"))
        if name not in kept.__dict__:
            kept.__dict__[name] = make()
        return kept.__dict__[name]

    return held


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/documents.parquet")


def text_bytes(text: Column | str) -> Column:
    """The UTF-8 bytes of a text; a null text is an empty one."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(text, F.lit("")).cast("binary")


def fresh(df: DataFrame) -> str:
    """A prefix that no column of ``df`` starts with, for columns of our own beside its own."""
    prefix = "_"
    while any(c.startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def own_columns(df: DataFrame) -> list[Column]:
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def row_key(id_col: str, text_col: str) -> Column:
    """A key of the rows that hold one id and one text, for joins back to the documents."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


#: Whether Spark deletes the shuffle files of a query when it ends, not when they are collected.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def store(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read from there.

    Nothing reads the shuffle files of the write again, so they go at its end and do not lie
    beside those of the next step.
    """
    conf = df.sparkSession.conf
    before = conf.get(_CLEAN)
    conf.set(_CLEAN, "true")
    try:
        return materialize(df, label)
    finally:
        conf.set(_CLEAN, before)


def text_blocks(batches: Iterator[pa.RecordBatch], size_of: str, limit: int = BLOCK_BYTES):
    """The rows of a partition in blocks of about ``limit`` bytes: lists of columns by name.

    A block holds whole rows, one row at least, so its size is bounded by the limit and the
    longest text.
    """
    held: dict[str, list] = {}
    size = 0
    for batch in batches:
        columns = {name: batch.column(name) for name in batch.schema.names}
        texts = columns[size_of]
        for i in range(batch.num_rows):
            for name, values in columns.items():
                held.setdefault(name, []).append(values[i].as_py())
            size += len(texts[i].as_py()) if texts[i].is_valid else 0
            if size >= limit:
                yield held
                held, size = {}, 0
    if held:
        yield held


def sorted_runs(batches: Iterator[pa.RecordBatch], keys: list[str]):
    """The rows of a sorted partition as column arrays that never cut a run of equal keys.

    Yields dictionaries of NumPy arrays (of object lists for binary columns). Only the last run
    of a batch is held back, so memory is bounded by a batch and the longest run.
    """
    held: list[dict[str, np.ndarray]] = []

    def joined(parts):
        return {name: np.concatenate([p[name] for p in parts]) for name in parts[0]}

    for batch in batches:
        if not batch.num_rows:
            continue
        part = {
            name: batch.column(name).to_numpy(zero_copy_only=False)
            for name in batch.schema.names
        }
        n = batch.num_rows
        changes = np.zeros(n, dtype=bool)
        for key in keys:
            changes[1:] |= part[key][1:] != part[key][:-1]
            if held:
                changes[0] |= part[key][0] != held[-1][key][-1]
        starts = np.flatnonzero(changes)
        if not held and not len(starts):
            held = [part]
            continue
        if not len(starts):
            held.append(part)
            continue
        cut = starts[-1]
        done = [*held, {name: values[:cut] for name, values in part.items()}]
        if sum(len(p[keys[0]]) for p in done):
            yield joined(done)
        held = [{name: values[cut:] for name, values in part.items()}]
    if held:
        yield joined(held)


def run_starts(*keys: np.ndarray) -> np.ndarray:
    """Where a new combination of keys starts, in arrays sorted by them."""
    n = len(keys[0])
    new = np.zeros(n, dtype=bool)
    if n:
        new[0] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def run_of_row(starts: np.ndarray, n: int) -> np.ndarray:
    """The number of each row's run."""
    marks = np.zeros(n, dtype=np.int64)
    marks[starts] = 1
    return np.cumsum(marks) - 1


def joined_runs(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of half-open intervals; touching ones become one."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(starts), dtype=bool)
    new[1:] = starts[1:] > ends[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:] - 1, len(starts) - 1)
    return starts[first], ends[last]


def signed(values) -> np.ndarray:
    """Unsigned 64-bit numbers as the signed ones that Spark stores."""
    return np.asarray(values, dtype=np.uint64).view(np.int64)
