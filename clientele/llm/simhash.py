"""SimHash near-duplicates through an inverted index on byte positions with count filtering.

A fingerprint has eight bytes. Two fingerprints that differ in at most ``max_bits`` = 3 bits
differ in at most three bytes, so they share at least five positional bytes. The index posts
each distinct fingerprint under combinations of three positional bytes; the eight combinations
are the triples inside the two halves of the positions, and any five positions hold three of one
half, so a pair that shares five bytes meets in a list. Inside a list the shared positional bytes
of each pair are tallied, pairs with fewer than the guaranteed matches are left out, and the
bit distance of the others is verified.

Nulls and ties: a null text is an empty one; a text without words has fingerprint zero and links
like any other; a null id takes part in linking but never names a component. Repeated rows share
a fingerprint and thus a component. Other columns of the input are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.functions.components import connected_components
from clientele.functions.unions import unite
from clientele.llm.common import documents, run_starts, sorted_runs, store, text_blocks, text_bytes

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
#: A posting list beyond this length is compared in pairs of parts, each in a task of its own.
LIST_ROWS = 4096
#: Bound of the table of such lists, which is broadcast. A list that is not among them has at
#: most a ten-thousandth of all postings and is compared in tiles inside its task.
LONG_LISTS = 10_000
#: Rows of a tile of pairs.
TILE = 1024
_HASHES = 1 << 16


def fingerprint(data: bytes, words: int = SHINGLE_WORDS) -> int:
    """The SimHash of a text's bytes: majority of the bits of its shingles' XXH64."""
    parts = data.lower().split()
    n = len(parts)
    if not n:
        return 0
    joined = b" ".join(parts)
    lengths = np.fromiter(map(len, parts), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    if n < words:
        starts, ends = starts[:1], ends[-1:]
    else:
        starts, ends = starts[: n - words + 1], ends[words - 1:]
    votes = np.zeros(64, dtype=np.int64)
    total = len(starts)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, _HASHES):
        bounds = zip(starts[at:at + _HASHES].tolist(), ends[at:at + _HASHES].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in bounds], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * votes > total).tolist())


def fingerprints(df: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(``id_col``, fingerprint as a signed long) of every row."""
    id_type = df.schema[id_col].dataType.simpleString()

    def each(batches):
        for block in text_blocks(batches, "text"):
            prints = np.array([fingerprint(t, words) for t in block["text"]], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block["id"], ids), pa.array(prints.view(np.int64))], ["id", "print"]
            )

    rows = df.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text"))
    ids = pa.int64() if id_type == "bigint" else pa.string()
    if id_type != "bigint":
        rows = rows.withColumn("id", F.col("id").cast("string"))
    return rows.mapInArrow(each, f"id {'bigint' if id_type == 'bigint' else 'string'}, print bigint")


def _combinations(positions: int, matches: int) -> list[tuple[int, ...]]:
    """Position sets one of which lies inside any ``matches`` of the positions."""
    half = positions // 2
    size = -(-matches // 2)
    sides = [range(half), range(half, positions)]
    return [c for side in sides for c in combinations(side, size)]


def _postings(batches, sets):
    for batch in batches:
        prints = batch.column("print").to_numpy()
        parts = prints.view(np.uint8).reshape(-1, 8).astype(np.int64)
        for number, positions in enumerate(sets):
            key = np.full(len(prints), number, dtype=np.int64)
            for p in positions:
                key = (key << 8) | parts[:, p]
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(prints)], ["list", "print"]
            )


def _linked(prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect the fingerprints of one list wherever their pairs are within the bits.

    The tally and the verification run over tiles of pairs. Of the pairs found only a spanning
    forest is returned, one edge a fingerprint at most.
    """
    n = len(prints)
    parts = np.ascontiguousarray(prints).view(np.uint8).reshape(-1, 8)
    bits = prints.view(np.uint64)
    matches = 8 - max_bits
    label = np.arange(n)
    for a in range(0, n, TILE):
        for b in range(a, n, TILE):
            left, right = parts[a:a + TILE], parts[b:b + TILE]
            tally = np.zeros((len(left), len(right)), dtype=np.uint8)
            for p in range(8):
                tally += left[:, p, None] == right[None, :, p]
            i, j = np.nonzero(tally >= matches)
            i, j = i + a, j + b
            keep = i < j
            i, j = i[keep], j[keep]
            near = np.bitwise_count(bits[i] ^ bits[j]) <= max_bits
            unite(label, i[near], j[near])
    others = np.flatnonzero(label != np.arange(n))
    return prints[others], prints[label[others]]


def _near_pairs(batches, max_bits):
    for chunk in sorted_runs(batches, ["list", "lo", "hi"]):
        starts = run_starts(chunk["list"], chunk["lo"], chunk["hi"])
        ends = np.append(starts[1:], len(chunk["list"]))
        many = np.flatnonzero(ends - starts > 1)
        found = [_linked(chunk["print"][starts[g]:ends[g]], max_bits) for g in many]
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(side)) for side in zip(*found, strict=True)], ["u", "v"]
            )


def near_edges(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges (u, v) that connect the distinct fingerprints within ``max_bits`` of each other.

    Their connected components are those of all such pairs; pairs that other edges imply are
    left out. A list of more than LIST_ROWS fingerprints is dealt to tasks as pairs of parts.
    """
    sets = _combinations(8, 8 - max_bits)
    posted = prints.select("print").mapInArrow(
        lambda batches: _postings(batches, sets), "list bigint, print bigint"
    )
    long = (
        posted.groupBy("list").agg(F.count("*").alias("rows")).where(F.col("rows") > LIST_ROWS)
        .orderBy(F.desc("rows"), "list").limit(LONG_LISTS)
        .select("list", F.ceil(F.col("rows") * 2 / LIST_ROWS).cast("int").alias("parts"))
    )
    part = F.pmod(F.xxhash64("print"), F.col("parts")).cast("int")
    dealt = (
        posted.join(F.broadcast(long), "list", "left")
        .withColumn("part", F.coalesce(part, F.lit(0)))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
        .select("list", "print", F.least("part", "other").alias("lo"),
                F.greatest("part", "other").alias("hi"))
    )
    keys = ["list", "lo", "hi"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(
        lambda batches: _near_pairs(batches, max_bits), "u bigint, v bigint"
    )


def simhash_components(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per document: ``id_col``, fingerprint (long), component_id (its smallest id)."""
    if not 0 <= max_bits <= 7:
        raise ValueError("max_bits must be between 0 and 7")
    rows = store(fingerprints(df, id_col, text_col, words), "simhash")
    prints = store(rows.groupBy("print").agg(F.min("id").alias("least")), "prints")
    edges = store(near_edges(prints, max_bits), "simhash-edges")
    groups = connected_components(edges, "u", "v").withColumnRenamed("vertex", "print")
    named = prints.join(groups, "print", "left").withColumn(
        "group", F.coalesce("component", "print")
    )
    least = named.groupBy("group").agg(F.min("least").alias("component_id"))
    of_print = store(named.join(least, "group").select("print", "component_id"), "simhash-groups")
    return rows.join(of_print, "print").select(
        F.col("id").cast(df.schema[id_col].dataType).alias(id_col),
        F.col("print").alias("fingerprint"),
        F.col("component_id").cast(df.schema[id_col].dataType).alias("component_id"),
    )


def keep_one_of_each(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS):
    """The documents that name their component, one row of each; all columns as they are.

    Documents without an id cannot be told apart and stay.
    """
    found = simhash_components(docs, words=words, max_bits=max_bits)
    kept = found.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    named = docs.where(F.col("doc_id").isNotNull()).join(kept, "doc_id", "left_semi")
    return named.dropDuplicates(["doc_id"]).unionByName(docs.where(F.col("doc_id").isNull()))


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash_components(documents(spark, folder))
    return found.withColumn("fingerprint", F.lpad(F.lower(F.hex("fingerprint")), 16, "0"))
