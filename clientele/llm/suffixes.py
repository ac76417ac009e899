"""Repeated byte strings found in suffix arrays that two-stage sorting builds.

Where to look: every string of ``length`` bytes holds an anchor, its 16-byte stretch of least
hash, so equal strings hold equal anchors at the same offset. The strings of a document that
share one anchor are consecutive and lie in one context of less than twice the length. Contexts
whose anchor occurs again are dealt to tasks by the anchor, so all occurrences of a string meet.

Two-stage sorting (Itoh and Tanaka 1999): of the contexts in a task, joined to one text, only
the suffixes smaller than their successors are sorted directly. Every other suffix is induced by
one scan over the buckets of first bytes: the scan meets the suffixes in order and appends the
suffix one byte before each to the bucket of that byte. Then the common prefixes of adjacent
suffixes are computed; a run of prefixes of ``length`` bytes or more holds the occurrences of one
string, of which the earliest stays.

Before that, equal contexts become one: all but the earliest are repeats as a whole. An anchor
that is among the 10,000 most frequent ones and occurs MANY times or more may hold a third of all
documents, so its strings are dealt one by one, by a 128-bit hash of the whole string, and a
block of documents passes on the earliest of each only. That table of anchors is broadcast; any
other anchor has at most a ten-thousandth of all occurrences or fewer than MANY.

Nulls and ties: a null text is empty. A null id sorts after every other; rows that share an id
are one document as to the order, so equal starts in them are no repeats of each other. Texts
shorter than ``length`` lose nothing. Other columns are not read.
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
    joined_runs,
    row_key,
    run_of_row,
    run_starts,
    sorted_runs,
    store,
    text_blocks,
    text_bytes,
)

LENGTH = 100
GRAM = 16
MANY = 1000
HOT_ANCHORS = 10_000
#: Windows that one step of the anchor search handles; its positions fit below the hash bits.
_STEP = 1 << 20
_PLACE = np.uint64((1 << 21) - 1)
#: A byte that UTF-8 never uses, between the contexts.
_GAP = 0xFF

_CONTEXTS = (
    "k1 bigint, k2 bigint, ord bigint, uid bigint, start int, len int, known boolean, text binary"
)
_SPANS = "ord bigint, uid bigint, start int, len int"
_KEYS = ["k1", "k2"]


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number."""
    two = data[:-1].astype(np.uint64) | (data[1:].astype(np.uint64) << np.uint64(8))
    four = two[:-2] | (two[2:] << np.uint64(16))
    return four[:-4] | (four[4:] << np.uint64(32))


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    words = _words(data)
    h = words[:-8] * np.uint64(0x9E3779B185EBCA87) ^ (words[8:] + np.uint64(0x165667B19E3779F9)) * (
        np.uint64(0xC2B2AE3D27D4EB4F)
    )
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of each window, from running minima inside blocks of the width."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = values
    padded = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1:n])


def anchor_runs(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, place, first and last string start of each anchor of a text.

    The anchor of a string is the leftmost of its stretches with the least hash, compared by the
    upper 43 bits.
    """
    n = len(data)
    none = np.zeros(0, dtype=np.int64)
    if n < length:
        return none, none, none, none
    array = np.frombuffer(data, dtype=np.uint8)
    parts = []
    for at in range(0, n - length + 1, _STEP):
        piece = array[at:at + _STEP + length - 1]
        hashes = _gram_hashes(piece)
        keyed = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
        place = (_least_in_windows(keyed, length - GRAM + 1) & _PLACE).astype(np.int64)
        starts = run_starts(place)
        ends = np.append(starts[1:], len(place)) - 1
        parts.append((hashes[place[starts]].view(np.int64), place[starts] + at, starts + at, ends + at))
    return tuple(np.concatenate(side) for side in zip(*parts, strict=True))


def _anchors(length: int):
    def find(data: bytes):
        hashes, places, _, _ = anchor_runs(data, length)
        return hashes, places

    return find


def _contexts(batches, length: int, hot):
    """Contexts of the candidate anchors; a block settles equal ones among itself."""
    often = hot.value
    for block in text_blocks(batches, "text"):
        rows: list[tuple[int, int, int, bytes]] = []
        singles: list[tuple[np.ndarray, np.ndarray, list[bytes]]] = []
        for i, (data, near) in enumerate(zip(block["text"], block["near"], strict=True)):
            hashes, places, first, last = anchor_runs(data, length)
            wanted = np.isin(places, np.array(near, dtype=np.int64))
            frequent = wanted & np.isin(hashes, often)
            wanted &= ~frequent
            rows.extend(
                (key, i, a, data[a:b + length]) for key, a, b in zip(
                    hashes[wanted].tolist(), first[wanted].tolist(), last[wanted].tolist(),
                    strict=True)
            )
            if frequent.any():
                at = np.concatenate([
                    np.arange(a, b + 1) for a, b in zip(first[frequent], last[frequent], strict=True)
                ])
                digests = [xxhash.xxh3_128_digest(data[a:a + length]) for a in at.tolist()]
                singles.append((np.full(len(at), i), at, digests))
        ids = np.array(block["ord"], dtype=np.int64)
        uids = np.array(block["uid"], dtype=np.int64)
        if rows:
            yield from _settled_contexts(rows, ids, uids, length)
        if singles:
            yield from _settled_strings(singles, ids, uids)


def _settled_contexts(rows, ids, uids, length):
    number: dict[bytes, int] = {}
    same = np.array([number.setdefault(text, len(number)) for *_, text in rows])
    owner = np.array([i for _, i, _, _ in rows])
    start = np.array([a for _, _, a, _ in rows], dtype=np.int64)
    later = _later(same, ids[owner], start)
    keep = np.flatnonzero(~later)
    keys = np.array([rows[k][0] for k in keep], dtype=np.int64)
    yield _batch(keys, np.zeros_like(keys), ids[owner[keep]], uids[owner[keep]], start[keep],
                 np.zeros(len(keep)), False, [rows[k][3] for k in keep])
    if later.any():
        sizes = np.array([len(text) - length + 1 for *_, text in rows])
        yield _known(ids[owner[later]], uids[owner[later]], start[later], sizes[later])


def _settled_strings(singles, ids, uids):
    owner = np.concatenate([o for o, _, _ in singles])
    start = np.concatenate([s for _, s, _ in singles])
    pairs = np.frombuffer(b"".join(d for *_, ds in singles for d in ds), dtype=np.int64).reshape(-1, 2)
    order = np.lexsort((pairs[:, 1], pairs[:, 0]))
    group = np.empty(len(order), dtype=np.int64)
    group[order] = run_of_row(run_starts(pairs[order, 0], pairs[order, 1]), len(order))
    later = _later(group, ids[owner], start)
    keep = ~later
    yield _batch(pairs[keep, 0], pairs[keep, 1], ids[owner[keep]], uids[owner[keep]], start[keep],
                 np.zeros(keep.sum()), False, [None] * int(keep.sum()))
    if later.any():
        yield _known(*_run_rows(owner[later], start[later], ids, uids))


def _run_rows(owner, start, ids, uids):
    """Runs of consecutive starts of each owner: order, row key, first start, length."""
    order = np.lexsort((start, owner))
    owner, start = owner[order], start[order]
    first = run_starts(owner, start - np.arange(len(start)))
    sizes = np.diff(np.append(first, len(start)))
    return ids[owner[first]], uids[owner[first]], start[first], sizes


def _later(group: np.ndarray, ids: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Whether another member of the row's group lies strictly earlier."""
    later = np.zeros(len(group), dtype=bool)
    several = np.flatnonzero(np.bincount(group, minlength=1)[group] > 1)
    if len(several):
        group, ids, start = group[several], ids[several], start[several]
        order = np.lexsort((start, ids, group))
        first = run_starts(group[order])
        head = order[first][run_of_row(first, len(order))]
        later[several[order]] = (ids[order] != ids[head]) | (start[order] != start[head])
    return later


def _known(ids, uids, start, sizes) -> pa.RecordBatch:
    spread = np.random.default_rng(len(ids)).integers(-(2**63), 2**63, len(ids))
    return _batch(spread, np.zeros_like(spread), ids, uids, start, sizes, True, [None] * len(ids))


def _batch(k1, k2, ids, uids, start, sizes, known, texts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(k1), pa.array(k2), pa.array(ids), pa.array(uids),
         pa.array(np.asarray(start).astype(np.int32)), pa.array(np.asarray(sizes).astype(np.int32)),
         pa.array(np.full(len(k1), known)), pa.array(texts, pa.binary())],
        ["k1", "k2", "ord", "uid", "start", "len", "known", "text"],
    )


def _sort_directly(keys: np.ndarray, suffixes: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes by their first ``depth`` bytes; only ties are looked at further."""
    order = suffixes[np.argsort(keys[suffixes])]
    first = run_starts(keys[order])
    group = first[run_of_row(first, len(order))]
    at = 8
    open_ = np.arange(len(order))
    while at < depth and len(open_):
        sizes = np.bincount(group[open_], minlength=1)
        open_ = open_[sizes[group[open_]] > 1]
        if not len(open_):
            break
        own, next_ = group[open_], keys[np.minimum(order[open_] + at, len(keys) - 1)]
        moved = np.lexsort((next_, own))
        order[open_] = order[open_][moved]
        own, next_ = own[moved], next_[moved]
        # Each part of a tie takes the place of its first member as its number.
        first = run_starts(own, next_)
        group[open_] = open_[first][run_of_row(first, len(open_))]
        at += 8
    return order


def two_stage_suffix_array(
    text: np.ndarray, depth: int, wanted: np.ndarray | None = None
) -> np.ndarray:
    """Suffixes of ``text`` (bytes) in the order of their first ``depth`` bytes at least.

    With ``wanted`` positions, those are among the result, and of the others only what their
    order is induced from: the suffixes from each one to the next directly sorted one.
    """
    n = len(text)
    if not n:
        return np.zeros(0, dtype=np.int64)
    wide = np.concatenate([text, np.zeros(8, dtype=np.uint8)])
    keys = np.append(_words(wide).byteswap()[:n], np.uint64(0))
    rises = np.zeros(n, dtype=bool)
    rises[:-1] = text[:-1] < text[1:]
    differs = np.ones(n, dtype=bool)
    differs[:-1] = text[:-1] != text[1:]
    # Inside a run of one byte every suffix compares as the last one of the run does.
    last = np.flatnonzero(differs)
    smaller = rises[last[np.searchsorted(last, np.arange(n))]]
    direct = np.flatnonzero(smaller)
    kept = np.ones(n, dtype=bool)
    if wanted is not None:
        until = np.append(direct, n - 1)[np.searchsorted(direct, wanted)]
        change = np.bincount(wanted, minlength=n + 1) - np.bincount(until + 1, minlength=n + 1)
        kept = np.cumsum(change[:n]) > 0
        direct = direct[kept[direct]]
    direct = _sort_directly(keys, direct, depth)
    bounds = np.searchsorted(text[direct], np.arange(257))
    queues: list[list[np.ndarray]] = [[] for _ in range(256)]
    found = []

    def induce(entries: np.ndarray, byte: int) -> np.ndarray:
        """Append the larger suffixes one byte before to their buckets; return this bucket's."""
        before = entries[entries > 0] - 1
        before = before[~smaller[before] & kept[before]]
        if not len(before):
            return before
        first = text[before]
        order = np.argsort(first, kind="stable")
        cuts = np.flatnonzero(np.diff(first[order])) + 1
        own = before[:0]
        for part in np.split(order, cuts):
            to = int(first[part[0]])
            if to == byte:
                own = before[part]
            else:
                queues[to].append(before[part])
        return own

    # The empty suffix is the least of all; it comes before the last byte.
    if kept[-1]:
        queues[int(text[-1])].append(np.array([n - 1]))
    for byte in range(256):
        if queues[byte]:
            entries = np.concatenate(queues[byte])
            queues[byte] = []
            while len(entries):
                found.append(entries)
                entries = induce(entries, byte)
        own = direct[bounds[byte]:bounds[byte + 1]]
        if len(own):
            found.append(own)
            induce(own, byte)
    return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)


def common_prefixes(keys: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Bytes that the suffixes a and b have in common at the front, up to ``most``."""
    length = np.zeros(len(a), dtype=np.int64)
    open_ = np.arange(len(a))
    for at in range(0, most, 8):
        x = keys[np.minimum(a[open_] + at, len(keys) - 1)] ^ keys[
            np.minimum(b[open_] + at, len(keys) - 1)]
        equal = x == 0
        apart = x[~equal]
        zeros = sum((apart >> np.uint64(shift) == 0).astype(np.int64) for shift in range(56, 0, -8))
        length[open_[~equal]] = at + zeros
        open_ = open_[equal]
        length[open_] = at + 8
    return np.minimum(length, most)


def repeated_strings(texts: list[bytes], ids: np.ndarray, start: np.ndarray, length: int):
    """Strings of the texts that another one holds earlier: numbers of texts, offsets.

    ``ids`` and ``start`` say where each text lies. One suffix array over all texts.
    """
    sizes = np.array([len(t) + 1 for t in texts])
    joined = np.frombuffer(b"".join(t + bytes([_GAP]) for t in texts), dtype=np.uint8)
    origin = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(texts)), sizes)
    left = (origin + sizes - 1)[owner] - np.arange(len(joined))
    order = two_stage_suffix_array(joined, length, np.flatnonzero(left >= length))
    order = order[left[order] >= length]
    if not len(order):
        return order, order
    keys = _words(np.concatenate([joined, np.zeros(8, dtype=np.uint8)])).byteswap()
    common = common_prefixes(keys, order[:-1], order[1:], length)
    group = np.zeros(len(order), dtype=np.int64)
    group[1:] = np.cumsum(common < length)
    text = owner[order]
    offset = order - origin[text]
    later = _later(group, ids[text], start[text] + offset)
    return text[later], offset[later]


def _later_strings(batches, length: int):
    for chunk in sorted_runs(batches, _KEYS):
        known = chunk["known"].astype(bool)
        parts = [tuple(chunk[c][known] for c in ("ord", "uid", "start", "len"))]
        k1, k2, ids, uid, start, text = (
            chunk[c][~known] for c in ("k1", "k2", "ord", "uid", "start", "text")
        )
        start = start.astype(np.int64)
        group = run_of_row(run_starts(k1, k2), len(k1)) if len(k1) else k1
        again = np.bincount(group)[group] > 1 if len(group) else np.zeros(0, dtype=bool)
        whole = np.array([t is None for t in text], dtype=bool)
        rows = np.flatnonzero(again & whole)
        if len(rows):
            rows = rows[_later(group[rows], ids[rows], start[rows])]
            parts.append(_run_rows(np.unique(uid[rows], return_inverse=True)[1], start[rows],
                                   *_by_key(ids[rows], uid[rows])))
        rows = np.flatnonzero(again & ~whole)
        if len(rows):
            parts.extend(_later_in_contexts(
                [text[r] for r in rows], group[rows], ids[rows], uid[rows], start[rows], length
            ))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(side).astype(kind)) for side, kind in
             zip(zip(*parts, strict=True), (np.int64, np.int64, np.int32, np.int32), strict=True)],
            ["ord", "uid", "start", "len"],
        )


def _by_key(ids, uid):
    """Order and row key of each distinct row key."""
    keys, first = np.unique(uid, return_index=True)
    return ids[first], keys


def _later_in_contexts(texts, group, ids, uid, start, length):
    """Spans of contexts that lie earlier elsewhere: equal contexts whole, the others by string."""
    number: dict[bytes, int] = {}
    same = np.array([number.setdefault(t, len(number)) for t in texts])
    sizes = np.array([len(t) - length + 1 for t in texts])
    later = _later(same, ids, start)
    yield ids[later], uid[later], start[later], sizes[later]
    rows = np.flatnonzero(~later)
    # An anchor of which one context is left has no more strings to compare.
    kinds = np.unique(np.column_stack([group[rows], same[rows]]), axis=0)[:, 0]
    several = np.bincount(kinds, minlength=group.max() + 1) > 1
    rows = rows[several[group[rows]]]
    if len(rows):
        text, offset = repeated_strings([texts[r] for r in rows], ids[rows], start[rows], length)
        yield _run_rows(text, start[rows][text] + offset, ids[rows], uid[rows])


def _kept_bytes(data: bytes, spans, length: int) -> tuple[int, int, bytes]:
    """Bytes removed, maximal removed runs, and the bytes that stay."""
    first = np.array([s["start"] for s in spans], dtype=np.int64)
    last = first + np.array([s["len"] for s in spans], dtype=np.int64) + length - 1
    kept, at, removed = [], 0, 0
    runs = list(zip(*(side.tolist() for side in joined_runs(first, last)), strict=True))
    for a, b in runs:
        kept.append(data[at:a])
        at = b
        removed += b - a
    kept.append(data[at:])
    return removed, len(runs), b"".join(kept)


def _cut(batches, length: int):
    for block in text_blocks(batches, "text"):
        cut = [_kept_bytes(t, s, length) for t, s in zip(block["text"], block["spans"], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(block["ord"], pa.int64()), pa.array(block["uid"], pa.int64()),
             pa.array([n for n, _, _ in cut], pa.int64()),
             pa.array([n for _, n, _ in cut], pa.int64()),
             pa.array([hashlib.sha256(kept).hexdigest() for *_, kept in cut]),
             pa.array([kept for *_, kept in cut], pa.binary())],
            ["ord", "uid", "n_removed", "n_spans", "kept_sha256", "kept"],
        )


def without_repeated_bytes(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
    texts: bool = False,
) -> DataFrame:
    """What each text keeps once every string of ``length`` bytes that starts earlier is removed.

    One row per row of ``df``: ord (the id, null as the largest long), uid (hash of id and text),
    n_bytes, n_removed, n_spans, kept_sha256, and with ``texts`` the bytes kept where some went
    (they need not be whole characters).
    """
    if length < 2 * GRAM:
        raise ValueError(f"strings must have {2 * GRAM} bytes at least")
    spark = df.sparkSession
    rows = df.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("ord"),
        row_key(id_col, text_col).alias("uid"), text_bytes(text_col).alias("text"),
    )
    base = store(
        rows.select("ord", "uid", F.length("text").cast("bigint").alias("n_bytes"),
                    F.sha2("text", 256).alias("sha256")), "bytes",
    )
    first = base.groupBy("sha256").agg(F.min("ord").alias("least"), F.count("*").alias("n"))
    first = store(first.where(F.col("n") > 1), "repeated")
    copies = store(
        base.join(first, "sha256").where(F.col("ord") > F.col("least"))
        .select("ord", "uid", F.lit(True).alias("copy")).distinct(), "copies",
    )
    found = store(
        repeated_anchors(rows.select("uid", "text"), _anchors(length), True, MANY)
        .where((F.col("pos") >= 0) | (F.col("n") > 0)).select(
            F.when(F.col("pos") < 0, F.col("key")).alias("key"), "uid", "pos", "n"), "anchors",
    )
    often = found.where(F.col("pos") < 0).orderBy(F.desc("n"), "key").limit(HOT_ANCHORS).collect()
    hot = spark.sparkContext.broadcast(np.array([r.key for r in often], dtype=np.int64))
    near = found.where(F.col("pos") >= 0).groupBy("uid").agg(F.collect_list("pos").alias("near"))
    wanted = near.join(copies.select("uid"), "uid", "left_anti")
    candidates = store(rows.join(wanted, "uid").dropDuplicates(["ord", "uid"]), "candidates")
    contexts = candidates.mapInArrow(lambda b: _contexts(b, length, hot), _CONTEXTS)
    later = contexts.repartition(*_KEYS).sortWithinPartitions(*_KEYS).mapInArrow(
        lambda b: _later_strings(b, length), _SPANS
    )
    key = ["ord", "uid"]
    spans = store(
        later.groupBy(*key).agg(F.collect_list(F.struct("start", "len")).alias("spans")), "spans"
    )
    cut = candidates.select(*key, "text").join(spans, key).mapInArrow(
        lambda b: _cut(b, length),
        "ord bigint, uid bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary",
    )
    cut = store(cut if texts else cut.drop("kept"), "cut")
    gone = F.coalesce("copy", F.lit(False)) & (F.col("n_bytes") >= length)
    nothing = hashlib.sha256(b"").hexdigest()
    columns = [
        "ord", "uid", "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0)))
        .cast("bigint").alias("n_removed"),
        F.when(gone, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint")
        .alias("n_spans"),
        F.when(gone, F.lit(nothing)).otherwise(F.coalesce("kept_sha256", "sha256"))
        .alias("kept_sha256"),
    ]
    if texts:
        columns.append(F.when(gone, F.lit("").cast("binary")).otherwise(F.col("kept")).alias("kept"))
    return base.join(cut, key, "left").join(copies, key, "left").select(*columns)


def op8_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    return without_repeated_bytes(documents(spark, folder)).select(
        F.when(F.col("ord") != NO_ID, F.col("ord")).alias("doc_id"),
        "n_bytes", "n_removed", "n_spans", "kept_sha256",
    )


SQL = f"""
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(doc_id, {NO_ID}) AS ord,
         hex(encode(coalesce(text, ''))) AS h FROM documents),
strings AS (
  SELECT row, ord, i, md5(substr(h, 2 * i + 1, {2 * LENGTH})) AS s
  FROM (SELECT row, ord, h, unnest(generate_series(0, length(h) // 2 - {LENGTH})) AS i FROM texts)),
firsts AS (
  SELECT row, ord, i, min(ord) OVER (PARTITION BY s) AS least_ord,
         min(i) OVER (PARTITION BY s, ord) AS least_i FROM strings),
later AS (SELECT row, i FROM firsts WHERE ord > least_ord OR i > least_i),
numbered AS (
  SELECT row, i, sum(new) OVER (PARTITION BY row ORDER BY i) AS run
  FROM (SELECT row, i, CASE WHEN i - lag(i) OVER (PARTITION BY row ORDER BY i) <= {LENGTH} THEN 0
                       ELSE 1 END AS new FROM later)),
runs AS (SELECT row, min(i) AS a, max(i) + {LENGTH} AS b FROM numbered GROUP BY row, run),
gaps AS (
  SELECT row, a, coalesce(lag(b) OVER (PARTITION BY row ORDER BY a), 0) AS from_ FROM runs
  UNION ALL
  SELECT t.row, length(h) // 2, coalesce(max(b), 0) FROM texts t LEFT JOIN runs r ON r.row = t.row
  GROUP BY t.row, h),
kept AS (
  SELECT row, string_agg(substr(h, 2 * from_ + 1, 2 * (a - from_)), '' ORDER BY a) AS h
  FROM gaps JOIN texts USING (row) GROUP BY row),
removed AS (SELECT row, sum(b - a) AS n, count(*) AS spans FROM runs GROUP BY row)
SELECT doc_id, length(t.h) // 2 AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed,
       coalesce(spans, 0) AS n_spans, sha256(unhex(coalesce(k.h, ''))) AS kept_sha256
FROM texts t LEFT JOIN removed USING (row) LEFT JOIN kept k USING (row)
"""
