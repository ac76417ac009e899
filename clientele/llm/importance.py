"""Importance resampling to a target distribution, drawn by an exact distributed sort.

Documents are bags of hashed features: all runs of one to three words, counted in buckets of a
CRC. A bucket's gain is the log of how much more often the target corpus has it than the documents
have, and the sum of the gains of a document's features is its log weight. The best scores, weight
plus Gumbel noise, are a draw without replacement in proportion to the weights.

The table of gains has one entry a bucket and travels to the tasks as an array; a text becomes
bucket numbers in whole arrays too, since the CRC of a run follows from those of its words.

Ranks come from parallel sorting by regular sampling (Shi and Schaeffer 1992): each partition is
sorted and written as a run; every so-manieth row of each run is a sample, and regular places of
the sorted samples are the splitters; runs count their rows between splitters, the counts' prefix
sums are the first ranks of the segments; segments that begin within the draw are exchanged,
merged, and their rows get the prefix sum plus their place. Segments beyond the draw stay where
they are.

Nulls and ties: a null text has no words; a text without words has no features and weight 0. A
null id counts as empty in the noise and comes after all ids. Equal scores go to the smaller id;
rows that share both come by features and weight, and then in the order they were written, so
repeated rows are drawn one by one. Texts of any length count whole. Without documents or without
a target the formulas still hold. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.llm.common import documents, store, text_blocks, text_bytes

BUCKETS = 10_000
RUN_WORDS = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
#: Rows that a segment of the sort holds in the mean, at most and at least, and samples for each.
SEGMENT_ROWS = 1_000_000
FEWEST_ROWS = 1_000
SEGMENT_SAMPLES = 16

_SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_TO_WORDS = bytes(
    0x20 if b in _SEPARATORS else b + 0x20 if 0x41 <= b <= 0x5A else b for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """Runs of letters, digits and non-ASCII bytes, A-Z in lower case."""
    return text.translate(_TO_WORDS).split()


class CrcShift:
    """The CRC of joined strings from the CRCs of their parts.

    Bytes behind a string move its CRC by a map that is linear over single bits and depends on
    their number only, so ``crc(a + b) = moved(crc(a), len(b)) ^ crc(b)``. A map is kept as four
    tables of 256 entries, one for each byte of a CRC.
    """

    def __init__(self):
        byte = np.arange(256, dtype=np.uint32)
        self._basis = np.stack([byte << np.uint32(8 * i) for i in range(4)])
        nothing = zlib.crc32(b"\0", 0)
        step = np.array(
            [[zlib.crc32(b"\0", int(v)) ^ nothing for v in part] for part in self._basis], np.uint32
        )
        self._powers = [step]
        self._row: dict[int, int] = {}
        self.tables = np.empty((0, 4, 256), dtype=np.uint32)

    @staticmethod
    def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
        found = table[0][crc & np.uint32(255)]
        for i in (1, 2, 3):
            found = found ^ table[i][(crc >> np.uint32(8 * i)) & np.uint32(255)]
        return found

    def _map_of(self, length: int) -> np.ndarray:
        found, bit = self._basis, 0
        while length >> bit:
            if bit == len(self._powers):
                self._powers.append(self._apply(self._powers[-1], self._powers[-1]))
            if length >> bit & 1:
                found = self._apply(self._powers[bit], found)
            bit += 1
        return found

    def rows_of(self, lengths: Sequence[int]) -> np.ndarray:
        """The place of each length's map in ``tables``."""
        new = sorted({n for n in lengths if n not in self._row})
        if new:
            self._row.update({n: len(self._row) + i for i, n in enumerate(new)})
            self.tables = np.concatenate([self.tables, [self._map_of(n) for n in new]])
        return np.array([self._row[n] for n in lengths], dtype=np.int64)

    def moved(self, crc: np.ndarray, rows: np.ndarray) -> np.ndarray:
        found = self.tables[rows, 0, crc & np.uint32(255)]
        for i in (1, 2, 3):
            found ^= self.tables[rows, i, (crc >> np.uint32(8 * i)) & np.uint32(255)]
        return found


class _Numbers(dict):
    """Numbers words in the order they are first met."""

    def __missing__(self, word):
        self[word] = number = len(self)
        return number


def feature_buckets(
    texts: Sequence[bytes], buckets: int = BUCKETS, longest: int = RUN_WORDS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each feature, its text, words of each text), all texts in one go.

    The distinct words are numbered and hashed once; runs of two words and more combine arrays.
    """
    numbers, crc_of = _Numbers(), CrcShift()
    rows = [[numbers[w] for w in words_of(text)] for text in texts]
    n_words = np.array([len(row) for row in rows], dtype=np.int64)
    flat = np.fromiter((n for row in rows for n in row), dtype=np.int64, count=int(n_words.sum()))
    own = np.array([zlib.crc32(w) for w in numbers], dtype=np.uint32)
    spaced = np.array([zlib.crc32(b" " + w) for w in numbers], dtype=np.uint32)
    lengths = crc_of.rows_of([len(w) + 1 for w in numbers])
    text_of = np.repeat(np.arange(len(rows)), n_words)
    found, owners = [], []
    run = own[flat]
    for n in range(1, longest + 1):
        if n > 1:
            # Runs of n words from those of n - 1 and the word behind each.
            last = flat[n - 1:]
            run = crc_of.moved(run[:len(last)], lengths[last]) ^ spaced[last]
        inside = text_of[:len(run)] == text_of[n - 1:n - 1 + len(run)]
        found.append((run[inside] % np.uint32(buckets)).astype(np.int64))
        owners.append(text_of[:len(run)][inside])
    return np.concatenate(found), np.concatenate(owners), n_words


def _count(batches: Iterator[pa.RecordBatch], buckets: int, longest: int):
    total = np.zeros(buckets, dtype=np.int64)
    for block in text_blocks(batches, "text"):
        total += np.bincount(feature_buckets(block["text"], buckets, longest)[0], minlength=buckets)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])


def bucket_counts(
    texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS, longest: int = RUN_WORDS
) -> np.ndarray:
    """How many features of all texts fall into each bucket; partitions send sums."""
    counted = texts.select(text_bytes(text_col).alias("text")).mapInArrow(
        lambda b: _count(b, buckets, longest), "bucket bigint, n bigint"
    )
    found = np.zeros(buckets, dtype=np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        found[row.bucket] = row.n
    return found


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * log ratio) of each bucket's smoothed shares, target over source."""
    s, t = source.astype(float), target.astype(float)
    n = float(len(s))
    return np.floor(1000 * np.log(
        (t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n))
    )).astype(np.int64)


def _weigh(batches, gains, longest: int):
    for block in text_blocks(batches, "text"):
        found, owner, n_words = feature_buckets(block["text"], len(gains.value), longest)
        # Doubles hold these sums of integers exactly.
        weight = np.bincount(owner, gains.value[found], len(n_words)).astype(np.int64)
        features = np.bincount(owner, minlength=len(n_words))
        yield pa.RecordBatch.from_arrays(
            [pa.array(block["doc_id"], pa.int64()), pa.array(n_words), pa.array(features),
             pa.array(weight)], ["doc_id", "n_words", "n_features", "weight"],
        )


def weigh(
    df: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
    longest: int = RUN_WORDS,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of each row."""
    sent = df.sparkSession.sparkContext.broadcast(gains)
    rows = df.select(F.col(id_col).cast("bigint").alias("doc_id"), text_bytes(text_col).alias("text"))
    return rows.mapInArrow(
        lambda b: _weigh(b, sent, longest),
        "doc_id bigint, n_words bigint, n_features bigint, weight bigint",
    )


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """floor(1000 * Gumbel noise), from a digest of the seed and the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


#: The order of the draw, as columns that all rise: scores fall, a null id is last, and rows equal
#: in these are told apart by where they were written.
_KEYS = ["fall", "late", "id", "n_features", "weight", "run", "place"]


def _sort_keys(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "fall": -F.col("score"), "late": F.col("doc_id").isNull().cast("int"),
        "id": F.coalesce("doc_id", F.lit(0)),
    })


def sorted_runs_of(rows: DataFrame) -> DataFrame:
    """``rows`` stored as sorted runs, one a partition, with (run, place) of each row."""
    keyed = _sort_keys(rows.where("eligible")).sortWithinPartitions(*_KEYS[:5])
    place = F.monotonically_increasing_id()
    return store(keyed.withColumn("run", F.shiftright(place, 33)).withColumn(
        "place", place.bitwiseAND(F.lit((1 << 33) - 1))
    ), "runs")


def regular_splitters(runs: DataFrame, rows: int, segments: int) -> list[tuple]:
    """Keys that cut the rows into segments, at regular places of the regular samples.

    Each run gives every so-manieth row, from a start of its own so that short runs count too:
    ``SEGMENT_SAMPLES`` a segment altogether, a fixed small share of the rows.
    """
    if segments < 2:
        return []
    step = max(1, rows // (segments * SEGMENT_SAMPLES))
    start = F.pmod(F.xxhash64("run"), F.lit(step))
    samples = sorted(
        map(tuple, runs.where(F.col("place") % step == start).select(*_KEYS).collect())
    )
    each = len(samples) / segments
    return sorted({samples[int(i * each)] for i in range(1, segments)} if samples else set())


def _into_segments(batches: Iterator[pa.RecordBatch], sent):
    """The segment of each row: how many splitters come before it or are it."""
    splitters = np.array(sent.value, dtype=np.int64).reshape(-1, len(_KEYS)).T
    n = splitters.shape[1]
    for batch in batches:
        keys = [
            np.concatenate([s, batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64)])
            for k, s in zip(_KEYS, splitters, strict=True)
        ]
        order = np.lexsort(keys[::-1])
        before = np.cumsum(order < n)
        segment = np.empty(len(order), dtype=np.int64)
        segment[order] = before
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(segment[n:])], [*batch.schema.names, "segment"]
        )


def _ranked(batches: Iterator[pa.RecordBatch], first, drawn: int):
    """Ranks of sorted segments: the rows of all earlier ones, then the place in the own."""
    segment, seen = None, 0
    for batch in batches:
        names = batch.column("segment").to_numpy()
        rank = np.empty(len(names), dtype=np.int64)
        cuts = np.flatnonzero(np.diff(names)) + 1
        for rows in np.split(np.arange(len(names)), cuts) if len(names) else ():
            if names[rows[0]] != segment:
                segment, seen = names[rows[0]], 0
            rank[rows] = first.value[int(segment)] + seen + 1 + np.arange(len(rows))
            seen += len(rows)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(rank, mask=rank > drawn)], [*batch.schema.names, "rank"]
        )


def _fields(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


def segment_count(rows: int, cores: int, segment_rows: int | None = None) -> int:
    if segment_rows:
        return -(-rows // segment_rows)
    return max(-(-rows // SEGMENT_ROWS), min(4 * cores, rows // FEWEST_ROWS))


def rank_best(
    runs: DataFrame, drawn: int, rows: int, segment_rows: int | None = None
) -> DataFrame:
    """``runs`` with ``rank`` 1, 2, ... of the ``drawn`` first rows, null for the others."""
    context = runs.sparkSession.sparkContext
    segments = segment_count(rows, context.defaultParallelism, segment_rows)
    splitters = context.broadcast(regular_splitters(runs, rows, segments))
    placed = runs.mapInArrow(lambda b: _into_segments(b, splitters), _fields(runs) + ", segment bigint")
    counts = {r.segment: r.n for r in placed.groupBy("segment").agg(F.count("*").alias("n")).collect()}
    firsts, before = {}, 0
    for segment in sorted(counts):
        firsts[segment] = before
        before += counts[segment]
    within = [s for s in firsts if firsts[s] < drawn]
    last = max(within, default=-1)
    exchanged = placed.where(F.col("segment") <= last).repartition(
        max(1, len(within)), "segment"
    ).sortWithinPartitions("segment", *_KEYS)
    sent = context.broadcast(firsts)
    ranked = exchanged.mapInArrow(
        lambda b: _ranked(b, sent, drawn), _fields(exchanged) + ", rank bigint"
    )
    beyond = placed.where(F.col("segment") > last).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.union(beyond)


def resample(
    df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    target_text: str = "text", percent: int = PERCENT, least_words: int = LEAST_WORDS,
    seed: int = SEED, buckets: int = BUCKETS, longest: int = RUN_WORDS,
    segment_rows: int | None = None,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank, n_words) of each row; rank is null if not drawn."""
    gains = bucket_gains(
        bucket_counts(df, text_col, buckets, longest),
        bucket_counts(target, target_text, buckets, longest),
    )
    weighed = weigh(df, gains, id_col, text_col, longest)
    scored = store(weighed.withColumns({
        "score": F.col("weight") + noise(F.col("doc_id"), seed),
        "eligible": F.col("n_words") >= least_words,
    }), "scored")
    rows = scored.where("eligible").count()
    drawn = percent * rows // 100
    names = ["doc_id", "n_features", "weight", "score", "rank", "n_words"]
    others = scored.where(~F.col("eligible")).withColumn("rank", F.lit(None).cast("bigint"))
    ranked = rank_best(sorted_runs_of(scored), drawn, rows, segment_rows)
    return ranked.select(*names).union(others.select(*names))


def op12_importance(spark: SparkSession, folder: str) -> DataFrame:
    target = spark.read.parquet(f"{folder.rstrip('/')}/benchmark.parquet")
    return resample(documents(spark, folder), target)
