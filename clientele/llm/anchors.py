"""Anchors that occur more than once: the candidate search of the exact-repeat operators.

An anchor is a hash of a short stretch of a document at a position that the content or the
period fixes. A repeat that is long enough shares an anchor at the same place of both
occurrences, so only stretches around anchors that occur again are looked at further.

A block of documents settles among itself the anchors that it holds more than once: their
positions are candidates whatever other blocks hold, and one marker row tells the others. So a
key that a third of all documents share reaches its task as one row a block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from clientele.llm.common import run_of_row, run_starts, sorted_runs, text_blocks

_ROWS = "key bigint, uid bigint, pos int, n int"
#: pos of a marker row, and n of a row that is a candidate already.
_MARKER, _KNOWN = -1, 0
_MIX = np.uint64(0x9E3779B97F4A7C15)

#: From a text's bytes: hashes and positions of its anchors.
Anchors = Callable[[bytes], tuple[np.ndarray, np.ndarray]]


def _settle(keys, uids, pos, within_one: bool) -> Iterator[pa.RecordBatch]:
    order = np.argsort(keys, kind="stable")
    keys, uids, pos = keys[order], uids[order], pos[order]
    starts = run_starts(keys)
    run = run_of_row(starts, len(keys))
    counts = np.diff(np.append(starts, len(keys)))
    if within_one:
        again = counts > 1
    else:
        again = np.minimum.reduceat(uids, starts) != np.maximum.reduceat(uids, starts)
    known = again[run]
    spread = (keys.view(np.uint64) ^ (pos.astype(np.uint64) * _MIX)).view(np.int64)
    marked = starts[again]
    yield _rows(
        np.concatenate([np.where(known, spread, keys), keys[marked]]),
        np.concatenate([uids, uids[marked]]),
        np.concatenate([pos, np.full(len(marked), _MARKER)]),
        np.concatenate([np.where(known, _KNOWN, 1), counts[again]]),
    )


def _rows(keys, uids, pos, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), pa.array(uids, pa.int64()),
         pa.array(pos.astype(np.int32)), pa.array(n.astype(np.int32))],
        ["key", "uid", "pos", "n"],
    )


def _gather(batches, anchors: Anchors, within_one: bool):
    for block in text_blocks(batches, "text"):
        found = [anchors(text) for text in block["text"]]
        sizes = [len(keys) for keys, _ in found]
        if not sum(sizes):
            continue
        uids = np.repeat(np.array(block["uid"], dtype=np.int64), sizes)
        keys = np.concatenate([keys for keys, _ in found])
        pos = np.concatenate([pos for _, pos in found]).astype(np.int64)
        yield from _settle(keys, uids, pos, within_one)


def _repeated(batches, within_one: bool, many: int):
    for chunk in sorted_runs(batches, ["key"]):
        known = chunk["n"] == _KNOWN
        yield _rows(*(chunk[c][known] for c in ("key", "uid", "pos", "n")))
        keys, uids, pos, n = (chunk[c][~known] for c in ("key", "uid", "pos", "n"))
        if not len(keys):
            continue
        starts = run_starts(keys)
        run = run_of_row(starts, len(keys))
        marker = pos == _MARKER
        again = np.maximum.reduceat(marker, starts)
        if within_one:
            again |= np.diff(np.append(starts, len(keys))) > 1
        else:
            again |= np.minimum.reduceat(uids, starts) != np.maximum.reduceat(uids, starts)
        out = again[run] & ~marker
        yield _rows(keys[out], uids[out], pos[out], np.zeros(out.sum(), dtype=np.int32))
        if many:
            total = np.add.reduceat(n.astype(np.int64), starts)
            often = total >= many
            size = int(often.sum())
            yield _rows(keys[starts][often], np.zeros(size, dtype=np.int64),
                        np.full(size, _MARKER), np.minimum(total[often], 2**31 - 1))


def repeated_anchors(
    texts: DataFrame, anchors: Anchors, within_one: bool, many: int = 0
) -> DataFrame:
    """(key, uid, pos, n) of the anchors of ``texts`` (uid, text) that occur again.

    ``within_one`` also counts two occurrences in one document. With ``many``, a row with
    position -1 names each key that occurs so often, with its count n.
    """
    rows = texts.mapInArrow(lambda batches: _gather(batches, anchors, within_one), _ROWS)
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(
        lambda batches: _repeated(batches, within_one, many), _ROWS
    )
