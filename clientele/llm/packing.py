"""Packing token sequences with as little waste as possible: dominance reduction, then best fit.

Documents become pieces of 1 to ``capacity`` tokens. Pieces of one length are interchangeable,
so an instance is the number of pieces of each length: a table of at most ``capacity`` rows,
however large the corpus is. It is solved on the driver and dealt back by rank.

Reduction (Martello and Toth 1990): a set with the largest open piece is fixed for good when it
dominates every other set with that piece, that is, when the pieces of any other set can be
exchanged for it without needing another sequence. With the space r that the piece leaves and k
the largest piece that fits into it, the set is the piece alone (nothing fits), the piece and k
(k fills r, or no two pieces fit together, or no three do and no two fill more than k), or the
piece, k and the next largest that fits (no three fit, and no other two could do what these do).
A piece that another fills exactly is fixed with it first, whichever piece is the largest, since
nothing can use that space better. What is left is packed best fit in falling length.

Nulls and ties: a null text is an empty one, whose one token is the end token. Pieces of equal
length are numbered by a hash of their place, so which sequence each goes to is arbitrary but
repeats. Rows that share an id are pieces of their own. A very long text becomes pieces of the
capacity, whatever its length; an empty table has no pieces. Other columns are not read.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clientele.llm.common import documents, kept_in_worker, store, text_blocks, text_bytes

CAPACITY = 1024
END = 2
TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
#: Pieces of one length are numbered in chunks of about this many.
CHUNK_ROWS = 256
#: Bytes of text that a task tokenizes before it passes on the pieces.
TEXT_BYTES = 1 << 20

_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, spread bigint"
#: Characters other than Latin letters, ASCII and general punctuation.
_OTHERS = re.compile("[^\x00-\x7f\xa1-\u02ff\u2010-\u2027]")


@kept_in_worker
def _fast():
    """The vocabulary of the tokenizer in the faster library."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(RANKS), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@kept_in_worker
def _exact():
    """The tokenizer of the .json file, which a worker loads when a text needs it."""
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(TOKENIZER))


@kept_in_worker
def _special() -> set[str]:
    """The strings of the added tokens, read from the file's list of them."""
    import json

    import public_tokenizers

    with open(public_tokenizers.path(TOKENIZER), encoding="utf-8") as file:
        text = file.read()
    start = text.index("[", text.index('"added_tokens"'))
    return {token["content"] for token in json.JSONDecoder().raw_decode(text, start)[0]}


def token_ids(text: str) -> np.ndarray:
    """The ids that the tokenizer of the .json file gives, without added special tokens.

    Plain text of Latin letters and general punctuation goes through the rank file of the same
    vocabulary, where both libraries split and merge alike; special strings and other scripts go
    through the tokenizer itself.
    """
    if not _OTHERS.search(text) and not any(s in text for s in _special()):
        return np.array(_fast().encode_ordinary(text), dtype="<u4")
    return np.array(_exact().encode(text, add_special_tokens=False).ids, dtype="<u4")


def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """Starts and lengths of the pieces of n tokens: full ones, the first one the rest."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def _pieces(batches, capacity: int, end: int):
    for block in text_blocks(batches, "text", TEXT_BYTES):
        rows: list[tuple] = []
        for ids, spread, data in zip(block["doc_id"], block["spread"], block["text"], strict=True):
            tokens = np.append(token_ids(data.decode()), np.uint32(end))
            rows.extend(
                (ids, i, s, n, zlib.crc32(tokens[s:s + n].tobytes()), spread)
                for i, (s, n) in enumerate(cut_points(len(tokens), capacity))
            )
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "spread"]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names
        )


class _Sizes:
    """Open pieces by length, with the queries the reduction asks."""

    def __init__(self, counts: dict[int, int]):
        self.count = {s: n for s, n in counts.items() if n > 0}
        self.sizes = sorted(self.count)

    def take(self, size: int, n: int = 1) -> None:
        self.count[size] -= n
        if not self.count[size]:
            del self.count[size]
            self.sizes.pop(bisect.bisect_left(self.sizes, size))

    def largest_within(self, space: int, without: tuple[int, ...] = ()) -> int | None:
        """The largest open length of at most ``space``, the given pieces being used."""
        for at in range(bisect.bisect_right(self.sizes, space) - 1, -1, -1):
            size = self.sizes[at]
            if self.count[size] > without.count(size):
                return size
        return None

    def smallest(self, n: int, without: tuple[int, ...] = ()) -> list[int]:
        """The n least open pieces, the given ones being used."""
        found: list[int] = []
        for size in self.sizes:
            found += [size] * min(n, self.count[size] - without.count(size))
            if len(found) >= n:
                break
        return found[:n]


def _dominant(open_: _Sizes, capacity: int) -> tuple[int, ...] | None:
    """A set with the largest piece that dominates all others with it, if one of the rules says."""
    big = open_.sizes[-1]
    space = capacity - big
    used = (big,)
    best = open_.largest_within(space, used)
    if best is None:
        return used
    least = open_.smallest(3, used)
    if best == space or len(least) < 2 or sum(least[:2]) > space:
        return big, best
    if len(least) == 3 and sum(least) <= space:
        return None
    pairs = list(_maximal_pairs(open_, space, used))
    if all(a + b <= best for a, b in pairs):
        return big, best
    second = open_.largest_within(space - best, (*used, best))
    if second is None:
        return None
    # Another pair (a, b) can stand in for (best, second) if each of its pieces fits one place.
    if all(a <= best and b <= second or a + b <= best for a, b in pairs):
        return big, best, second
    return None


def _maximal_pairs(open_: _Sizes, space: int, used) -> Iterator[tuple[int, int]]:
    """For each larger piece of a pair the largest other one that fits beside it."""
    for a in open_.sizes[: bisect.bisect_right(open_.sizes, space)]:
        if open_.count[a] > used.count(a):
            b = open_.largest_within(min(a, space - a), (*used, a))
            if b is not None:
                yield a, b


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[list, dict[int, int]]:
    """Sets fixed for good, as (lengths, how often), and the pieces that stay open."""
    open_ = _Sizes(counts)
    fixed: list[tuple[tuple[int, ...], int]] = []

    def fix(pieces: tuple[int, ...], n: int) -> None:
        for size in pieces:
            open_.take(size, n)
        fixed.append((pieces, n))

    if capacity in open_.count:
        fix((capacity,), open_.count[capacity])
    for size in [s for s in open_.sizes if s > capacity / 2]:
        other = min(open_.count.get(size, 0), open_.count.get(capacity - size, 0))
        if other:
            fix((size, capacity - size), other)
    half = capacity / 2
    if open_.count.get(half, 0) > 1:
        fix((capacity // 2, capacity // 2), open_.count[half] // 2)
    while open_.sizes and (pieces := _dominant(open_, capacity)):
        need = {s: pieces.count(s) for s in pieces}
        n = min(open_.count[s] // k for s, k in need.items())
        # Fewer other pieces leave fewer alternatives, so the set may be fixed as often as it can.
        fix(pieces, n)
    return fixed, dict(open_.count)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit in falling length; sequences with the same content are kept as one row.

    Each piece goes to the fullest sequence that has room. Pieces of one length fill all
    sequences of the best class before the next class, so classes stay few.
    """
    by_space: dict[int, list[list]] = {}
    spaces: list[int] = []

    def put(space: int, content: tuple[int, ...], n: int) -> None:
        if space not in by_space:
            by_space[space] = []
            bisect.insort(spaces, space)
        by_space[space].append([content, n])

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            at = bisect.bisect_left(spaces, size)
            if at == len(spaces):
                each = capacity // size
                full, rest = divmod(left, each)
                if full:
                    put(capacity - each * size, (size,) * each, full)
                if rest:
                    put(capacity - rest * size, (size,) * rest, 1)
                break
            space = spaces[at]
            content, n = by_space[space].pop()
            if not by_space[space]:
                del by_space[space]
                spaces.pop(at)
            each = space // size
            full = min(n, left // each)
            if full:
                put(space - each * size, content + (size,) * each, full)
            left -= full * each
            n -= full
            if n and left:
                put(space - left * size, content + (size,) * left, 1)
                n, left = n - 1, 0
            if n:
                put(space, content, n)
    return [(content, n) for rows in by_space.values() for content, n in rows]


def pack_lengths(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in order, number of sequences) that hold every piece."""
    fixed, left = reduce_by_dominance(counts, capacity)
    return fixed + best_fit(left, capacity)


def _places(patterns) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: ranks at which a run of sequences starts, its first sequence, the offset."""
    taken: dict[int, int] = {}
    found: dict[int, list[tuple[int, int, int]]] = {}
    first = 0
    for pieces, n in patterns:
        offset = 0
        for size in pieces:
            rank = taken.get(size, 0)
            found.setdefault(size, []).append((rank, first, offset))
            taken[size] = rank + n
            offset += size
        first += n
    return {s: tuple(np.array(c, dtype=np.int64) for c in zip(*rows)) for s, rows in found.items()}


def _place_rows(batches, places):
    """Sequence and offset of each piece from its length and its rank among the pieces of it."""
    for batch in batches:
        length = batch.column("length").to_numpy()
        rank = batch.column("rank").to_numpy()
        sequence = np.empty(len(length), dtype=np.int64)
        offset = np.empty(len(length), dtype=np.int64)
        order = np.argsort(length, kind="stable")
        cuts = np.flatnonzero(np.diff(length[order])) + 1
        for rows in np.split(order, cuts) if len(order) else ():
            ranks, firsts, offsets = places.value[int(length[rows[0]])]
            run = np.searchsorted(ranks, rank[rows], side="right") - 1
            sequence[rows] = firsts[run] + rank[rows] - ranks[run]
            offset[rows] = offsets[run]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in names] + [pa.array(sequence), pa.array(offset)],
            [*names, "sequence_id", "offset"],
        )


def pack(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
    end: int = END,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    rows = df.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(id_col, text_col).alias("spread"),
        text_bytes(text_col).alias("text"),
    )
    pieces = store(rows.mapInArrow(lambda b: _pieces(b, capacity, end), _PIECES), "pieces")
    return place_pieces(pieces, capacity)


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Sequence and offset for each piece of a stored table with length and spread.

    Ranks within a length come from chunks: a piece's chunk is a hash of its place, chunks are
    counted, and a piece ranks after all earlier chunks of its length.
    """
    spark = pieces.sparkSession
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = spark.sparkContext.broadcast(_places(pack_lengths(counts, capacity)))
    # A row for each length up to the capacity.
    chunks = spark.createDataFrame(
        [(s, -(-n // CHUNK_ROWS)) for s, n in counts.items()], "length bigint, chunks bigint"
    )
    number = F.pmod(F.xxhash64("spread", "doc_id", "piece"), F.col("chunks"))
    dealt = pieces.join(F.broadcast(chunks), "length").withColumn("chunk", number).drop("chunks")
    key = ["length", "chunk"]
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    first = dealt.groupBy(*key).agg(F.count("*").alias("n")).select(
        *key, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
    )
    within = Window.partitionBy(*key).orderBy("spread", "doc_id", "piece")
    ranked = dealt.withColumn("row", F.row_number().over(within)).join(first, key).withColumn(
        "rank", F.col("first") + F.col("row") - 1
    )
    # Stored, so that no task sorts while a Python worker runs beside it.
    return store(ranked.drop("spread", "chunk", "first", "row"), "ranked").mapInArrow(
        lambda b: _place_rows(b, places),
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
        "sequence_id bigint, offset bigint",
    )


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(documents(spark, folder))
