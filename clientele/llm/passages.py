"""Passages that repeat across documents, found through difference-cover anchors.

A difference cover of period v holds residues whose differences give every residue, so for any
two places i and j some shift d < v puts both i + d and j + d on covered positions. Anchors of
``window - v + 1`` words are hashed at covered positions only; two equal windows of ``window``
words therefore share an anchor at the same place inside both. Windows around an anchor that
another document holds as well are extended to their full length and compared as a whole, by a
128-bit hash of their bytes.

Nulls and ties: a null text has no words. A null id sorts after every other; rows that share an
id are one document as to the order, so neither's windows are earlier than the other's. A text
of fewer words than a window loses nothing. Columns of the input other than the two named ones
are not read by ``repeated_passages`` and stay as they are in ``without_repeats``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.llm.anchors import repeated_anchors
from clientele.llm.common import (
    NO_ID,
    documents,
    fresh,
    joined_runs,
    own_columns,
    row_key,
    run_of_row,
    run_starts,
    sorted_runs,
    store,
    text_blocks,
    text_bytes,
)

WINDOW = 50
#: A perfect difference set: each nonzero residue of 31 is one difference.
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)

_WINDOWS = "k1 bigint, k2 bigint, ord bigint, uid bigint, start int, len int, known boolean"
_SPANS = "ord bigint, uid bigint, start int, len int"
_KEYS = ["k1", "k2"]


def _check_cover(period: int, cover) -> None:
    if {(a - b) % period for a in cover for b in cover} != set(range(period)):
        raise ValueError("the cover's differences do not give every residue of the period")


def word_bounds(data: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words joined by one space, and where each starts and ends there."""
    parts = data.split()
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    return b" ".join(parts), ends - lengths, ends


def _anchors(window: int, period: int, cover):
    covered = np.zeros(period, dtype=bool)
    covered[[c % period for c in cover]] = True
    size = window - period + 1
    digest = xxhash.xxh3_64_intdigest

    def find(data: bytes):
        joined, starts, ends = word_bounds(data)
        n = len(starts)
        if n < window:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        places = np.arange(n - size + 1)
        places = places[covered[places % period]]
        bounds = zip(starts[places].tolist(), ends[places + size - 1].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b]) for a, b in bounds], dtype=np.uint64)
        return hashes.view(np.int64), places

    return find


def _windows_near(n: int, anchors: np.ndarray, window: int, period: int) -> np.ndarray:
    """Starts of the windows that hold one of the anchors within the reach of the cover."""
    change = np.zeros(n + 1, dtype=np.int64)
    last = n - window
    low = np.maximum(anchors - (period - 1), 0)
    high = np.minimum(anchors, last)
    fit = low <= high
    np.add.at(change, low[fit], 1)
    np.add.at(change, high[fit] + 1, -1)
    return np.flatnonzero(np.cumsum(change[:-1]) > 0)


def _window_rows(batches, window: int, period: int):
    """Hashes of the candidate windows; a block settles the windows it holds itself."""
    for block in text_blocks(batches, "text"):
        digests, owners, places = [], [], []
        for i, (data, near) in enumerate(zip(block["text"], block["near"], strict=True)):
            joined, starts, ends = word_bounds(data)
            if len(starts) < window:
                continue
            at = np.array(near, dtype=np.int64)
            at = _windows_near(len(starts), at[at < len(starts)], window, period)
            bounds = zip(starts[at].tolist(), ends[at + window - 1].tolist(), strict=True)
            digests.extend(xxhash.xxh3_128_digest(joined[a:b]) for a, b in bounds)
            owners.append(np.full(len(at), i))
            places.append(at)
        if not digests:
            continue
        pairs = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
        del digests
        owner, place = np.concatenate(owners), np.concatenate(places)
        uid = np.array(block["uid"], dtype=np.int64)
        ids = np.array(block["ord"], dtype=np.int64)
        order = np.lexsort((ids[owner], pairs[:, 1], pairs[:, 0]))
        k1, k2 = pairs[order, 0], pairs[order, 1]
        owner, place = owner[order], place[order]
        starts = run_starts(k1, k2)
        least = ids[owner[starts]][run_of_row(starts, len(k1))]
        later = ids[owner] > least
        keep = ~later
        yield _rows(k1[keep], k2[keep], ids[owner[keep]], uid[owner[keep]], place[keep],
                    np.ones(keep.sum()), False)
        if later.any():
            order = np.lexsort((place[later], owner[later]))
            owner, place = owner[later][order], place[later][order]
            starts = run_starts(owner, place - np.arange(len(place)))
            lengths = np.diff(np.append(starts, len(place)))
            owner, place = owner[starts], place[starts]
            spread = np.random.default_rng(len(place)).integers(-(2**63), 2**63, len(place))
            yield _rows(spread, spread, ids[owner], uid[owner], place, lengths, True)


def _rows(k1, k2, ids, uid, start, length, known) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(k1), pa.array(k2), pa.array(ids), pa.array(uid),
         pa.array(start.astype(np.int32)), pa.array(length.astype(np.int32)),
         pa.array(np.full(len(k1), known))],
        ["k1", "k2", "ord", "uid", "start", "len", "known"],
    )


def _later_windows(batches):
    for chunk in sorted_runs(batches, _KEYS):
        known = chunk["known"].astype(bool)
        parts = [[chunk[c][known] for c in ("ord", "uid", "start", "len")]]
        k1, k2, ids, uid, start, length = (
            chunk[c][~known] for c in ("k1", "k2", "ord", "uid", "start", "len")
        )
        if len(k1):
            starts = run_starts(k1, k2)
            least = np.minimum.reduceat(ids, starts)[run_of_row(starts, len(k1))]
            later = ids > least
            parts.append([c[later] for c in (ids, uid, start, length)])
        columns = [np.concatenate(side) for side in zip(*parts, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c) for c in columns], ["ord", "uid", "start", "len"]
        )


def _kept_words(data: bytes, spans, window: int) -> tuple[int, bytes]:
    """How many words covered windows take away, and the others joined by one space."""
    parts = data.split()
    first = np.array([s["start"] for s in spans], dtype=np.int64)
    last = first + np.array([s["len"] for s in spans], dtype=np.int64) + window - 1
    kept, at, removed = [], 0, 0
    for a, b in zip(*(side.tolist() for side in joined_runs(first, last)), strict=True):
        kept.extend(parts[at:a])
        at = b
        removed += b - a
    kept.extend(parts[at:])
    return removed, b" ".join(kept)


def _cut(batches, window: int, texts: bool):
    for block in text_blocks(batches, "text"):
        cut = [_kept_words(t, s, window) for t, s in zip(block["text"], block["spans"], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(block["ord"], pa.int64()), pa.array(block["uid"], pa.int64()),
             pa.array([removed for removed, _ in cut], pa.int64()),
             pa.array([hashlib.sha256(kept).hexdigest() for _, kept in cut]),
             pa.array([kept.decode() if texts else None for _, kept in cut], pa.string())],
            ["ord", "uid", "n_removed", "kept_sha256", "kept_text"],
        )


def _measure(batches):
    for batch in batches:
        texts = [b" ".join(t.as_py().split()) for t in batch.column("text")]
        counts = [t.count(b" ") + 1 if t else 0 for t in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column("ord"), batch.column("uid"), pa.array(counts, pa.int64()),
             pa.array([hashlib.sha256(t).hexdigest() for t in texts])],
            ["ord", "uid", "n_words", "sha256"],
        )


def repeated_passages(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
    period: int = PERIOD, cover: tuple[int, ...] = COVER, texts: bool = False,
) -> DataFrame:
    """What each document keeps once windows of a document with a smaller id are removed.

    One row per row of ``df``: ord (the id, null as the largest long), uid (hash of id and text),
    n_words, n_removed, kept_sha256 of the kept words joined by one space, and with ``texts``
    kept_text where something was removed.
    """
    _check_cover(period, cover)
    if period > window:
        raise ValueError("the period cannot exceed the window")
    rows = df.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("ord"),
        row_key(id_col, text_col).alias("uid"), text_bytes(text_col).alias("text"),
    )
    base = store(
        rows.mapInArrow(_measure, "ord bigint, uid bigint, n_words bigint, sha256 string"), "words"
    )
    first = base.groupBy("sha256").agg(F.min("ord").alias("least"), F.count("*").alias("n"))
    first = store(first.where(F.col("n") > 1), "repeated")
    copies = store(
        base.join(first, "sha256").where((F.col("ord") > F.col("least")))
        .select("ord", "uid", F.lit(True).alias("copy")).distinct(), "copies",
    )
    found = repeated_anchors(rows.select("uid", "text"), _anchors(window, period, cover), False)
    near = store(found.groupBy("uid").agg(F.collect_list("pos").alias("near")), "near")
    wanted = near.join(copies, "uid", "left_anti")
    candidates = store(rows.join(wanted, "uid"), "candidates")
    windows = candidates.mapInArrow(lambda b: _window_rows(b, window, period), _WINDOWS)
    later = windows.repartition(*_KEYS).sortWithinPartitions(*_KEYS).mapInArrow(
        _later_windows, _SPANS
    )
    key = ["ord", "uid"]
    spans = store(
        later.groupBy(*key).agg(F.collect_list(F.struct("start", "len")).alias("spans")), "spans"
    )
    cut = candidates.select(*key, "text").join(spans, key).mapInArrow(
        lambda b: _cut(b, window, texts),
        "ord bigint, uid bigint, n_removed bigint, kept_sha256 string, kept_text string",
    )
    cut = store(cut.dropDuplicates(key), "cut")
    gone = F.coalesce("copy", F.lit(False)) & (F.col("n_words") >= window)
    nothing = hashlib.sha256(b"").hexdigest()
    return base.join(cut, key, "left").join(copies, key, "left").select(
        "ord", "uid", "n_words",
        F.when(gone, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0)))
        .cast("bigint").alias("n_removed"),
        F.when(gone, F.lit(nothing)).otherwise(F.coalesce("kept_sha256", "sha256"))
        .alias("kept_sha256"),
        F.when(gone, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"),
    )


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without repeated passages; text and n_chars follow, other columns stay.

    A text that loses nothing stays as it is; one that loses words is its other words joined by
    one space. A document that loses all its words goes.
    """
    own = fresh(docs)
    ids, uid, kept, gone = (own + name for name in ("ord", "uid", "kept", "gone"))
    found = repeated_passages(docs, window=window, texts=True)
    changed = found.where(F.col("n_removed") > 0).dropDuplicates(["ord", "uid"]).select(
        F.col("ord").alias(ids), F.col("uid").alias(uid), F.col("kept_text").alias(kept),
        (F.col("n_removed") == F.col("n_words")).alias(gone),
    )
    keyed = docs.select(
        "*", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias(ids),
        row_key("doc_id", "text").alias(uid),
    )
    left = keyed.join(changed, [ids, uid], "left").where(~F.coalesce(gone, F.lit(False)))
    text = F.coalesce(kept, "text")
    chars = F.when(F.col(kept).isNull(), F.col("n_chars")).otherwise(F.length(text))
    new = {"text": text, "n_chars": chars.cast(docs.schema["n_chars"].dataType)}
    return left.select(
        *[new[c].alias(c) if c in new else o
          for c, o in zip(docs.columns, own_columns(docs), strict=True)]
    )


def op9_passages(spark: SparkSession, folder: str) -> DataFrame:
    found = repeated_passages(documents(spark, folder))
    return found.select(
        F.when(F.col("ord") != NO_ID, F.col("ord")).alias("doc_id"),
        "n_words", "n_removed", "kept_sha256",
    )


SQL = rf"""
WITH split AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(doc_id, {NO_ID}) AS ord,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT row, ord, i, md5(array_to_string(words[i:i + {WINDOW - 1}], ' ')) AS w
  FROM (SELECT row, ord, words, unnest(generate_series(1, len(words) - {WINDOW - 1})) AS i
        FROM split)),
later AS (
  SELECT row, i FROM (SELECT row, ord, i, min(ord) OVER (PARTITION BY w) AS least FROM windows)
  WHERE least < ord),
numbered AS (
  SELECT row, i, sum(new) OVER (PARTITION BY row ORDER BY i) AS run
  FROM (SELECT row, i, CASE WHEN i - lag(i) OVER (PARTITION BY row ORDER BY i) <= {WINDOW} THEN 0
                       ELSE 1 END AS new FROM later)),
runs AS (SELECT row, min(i) AS a, max(i) + {WINDOW} AS b FROM numbered GROUP BY row, run),
words_left AS (
  SELECT row, i, word FROM (
    SELECT row, unnest(words) AS word, unnest(generate_series(1, len(words))) AS i FROM split) w
  WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.row = w.row AND w.i >= a AND w.i < b)),
kept AS (SELECT row, string_agg(word, ' ' ORDER BY i) AS t FROM words_left GROUP BY row),
removed AS (SELECT row, sum(b - a) AS n FROM runs GROUP BY row)
SELECT doc_id, len(words) AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM split LEFT JOIN removed USING (row) LEFT JOIN kept USING (row)
"""
