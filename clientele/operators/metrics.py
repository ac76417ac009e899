"""How well labels fit the points they were given to.

``points`` holds an id, the scaled columns and one or more integer label columns; -1 marks
noise, which no metric counts. All label columns are measured in the same passes.

The silhouette needs the mean distance of each row to each cluster. For squared distances that
is a closed form of the cluster's size, mean and mean square, so the work is linear and every
row gets its exact value. For plain Euclidean distances, the default, no such form exists: the
work is quadratic by definition and runs in blocks of bounded size. The caller chooses by
``distance``, whatever the number of rows; the ``distance`` column says which one was used.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clientele.functions.agglomerate import SPLIT_SAMPLES, Splits
from clientele.functions.blocks import (
    FEWEST_ROWS,
    MOST_PARTITIONS,
    TILE_CELLS,
    distance_tiles,
    even_cuts,
    meet_in_blocks,
    plane_tiles,
)
from clientele.storage import materialize

#: Rows of a block of the triangular schedule, where every two blocks meet once, and sums that a
#: task holds for one: each row gets an array of sums from every block, so blocks are large.
BLOCK_ROWS = 500_000
BLOCK_SUMS = 1 << 24
#: Rows of a record of packed rows.
PACK_ROWS = 8_192
#: The same where all distances of two blocks are held at once.
PAIR_ROWS = 6_000
#: Clusters of all labelings up to which a row's sums over all of them are one array.
MOST_CLUSTERS = 256
#: Runs of rows with the same labels in a tile up to which each is summed on its own, and rows of
#: one from which it has tiles of its own.
MOST_RUNS = 24
RUN_ROWS = 64
#: Centres up to which all of them are sent to every task.
MOST_CENTERS = 4_096
#: Clusters of a block in the search for worst partners, and guests of it in one task.
BLOCK_CLUSTERS = 1_000
MOST_GUESTS = 50_000


def long_labels(points: DataFrame, columns: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """One row per point and label column, noise left out."""
    tags = [
        F.struct(F.lit(n).alias("labeling"), F.col(n).cast("int").alias("cluster")) for n in labels
    ]
    every = points.withColumn("_tag", F.explode(F.array(*tags)))
    others = [c for c in points.columns if c not in (*columns, *labels)]
    return every.select(*others, *columns, "_tag.*").where(F.col("cluster") != -1)


def cluster_centers(
    points: DataFrame, columns: Sequence[str], labels: Sequence[str]
) -> DataFrame:
    """Size, centre and inner sum of squares of each cluster: (labels x k) rows."""
    within = sum((F.var_pop(c) for c in columns), F.lit(0.0)) * F.count("*")
    return long_labels(points, columns, labels).groupBy("labeling", "cluster").agg(
        F.count("*").alias("n"),
        within.alias("within"),
        *[F.avg(c).alias(f"m_{c}") for c in columns],
    )


def _square_gap(left: Sequence[Column], right: Sequence[Column]) -> Column:
    return sum(((a - b) * (a - b) for a, b in zip(left, right)), F.lit(0.0))


def wcss(points: DataFrame, columns: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """Sum of squared distances to the own centre."""
    centers = cluster_centers(points, columns, labels)
    return centers.groupBy("labeling").agg(F.sum("within").alias("wcss"))


def calinski_harabasz(
    points: DataFrame, columns: Sequence[str], labels: Sequence[str]
) -> DataFrame:
    return _variance_ratio(cluster_centers(points, columns, labels), columns)


def _variance_ratio(centers: DataFrame, columns: Sequence[str]) -> DataFrame:
    own = Window.partitionBy("labeling")
    total = F.sum("n").over(own)
    means = [
        F.sum(F.col("n") * F.col(f"m_{c}")).over(own) / total for c in columns
    ]
    gap = _square_gap([F.col(f"m_{c}") for c in columns], means)
    sums = (
        centers.withColumn("_gap", gap * F.col("n"))
        .groupBy("labeling")
        .agg(
            F.count("*").alias("k"), F.sum("n").alias("rows"),
            F.sum("_gap").alias("between"), F.sum("within").alias("within"),
        )
    )
    k, n = F.col("k"), F.col("rows")
    ratio = F.try_divide(
        F.col("between") * (n - k), F.col("within") * (k - 1)
    )
    score = F.when(F.col("within") == 0, F.lit(1.0)).otherwise(ratio)
    return sums.select("labeling", score.alias("calinski_harabasz"))


def davies_bouldin(points: DataFrame, columns: Sequence[str], labels: Sequence[str]) -> DataFrame:
    centers = materialize(cluster_centers(points, columns, labels), "centers")
    return _davies_bouldin(points, columns, labels, centers)


def _davies_bouldin(points, columns, labels, centers) -> DataFrame:
    middle = [F.col(f"m_{c}") for c in columns]
    # The stored centres carry their size, so Spark itself decides whether to broadcast them.
    scatter = materialize(
        long_labels(points, columns, labels)
        .join(centers, ["labeling", "cluster"])
        .withColumn("_gap", F.sqrt(_square_gap([F.col(c) for c in columns], middle)))
        .groupBy("labeling", "cluster", *[f"m_{c}" for c in columns])
        .agg(F.avg("_gap").alias("scatter")),
        "scatter",
    )
    worst = worst_partners(scatter, [f"m_{c}" for c in columns])
    return worst.groupBy("labeling").agg(
        F.when(F.count("*") > 1, F.avg("worst")).alias("davies_bouldin")
    ).where(F.col("davies_bouldin").isNotNull())


def _overlaps(rows: pd.DataFrame, others: pd.DataFrame, middle: list[str]) -> np.ndarray:
    """The greatest (s_i + s_j) / d_ij of each row over other clusters; 0 at distance 0."""
    out = np.zeros(len(rows))
    own, other = rows["cluster"].to_numpy(), others["cluster"].to_numpy()
    scatter, far = rows["scatter"].to_numpy(), others["scatter"].to_numpy()
    tiles = distance_tiles(rows[middle].to_numpy(dtype=float), others[middle].to_numpy(dtype=float))
    for part, gaps in tiles:
        counted = (gaps > 0) & (own[part, None] != other)
        ratio = np.divide(scatter[part, None] + far, gaps, where=counted, out=np.zeros_like(gaps))
        out[part] = ratio.max(axis=1, initial=0.0)
    return out


def worst_partners(
    scatter: DataFrame, middle: list[str], block_clusters: int = BLOCK_CLUSTERS
) -> DataFrame:
    """(labeling, cluster, worst) for stored clusters (labeling, cluster, scatter, *middle).

    Clusters are cut into blocks by a tree of splits. Each finds its worst partner in its own
    block, and then visits only blocks that could hold a worse one: with the block's greatest
    scatter s and the distance d to its box, (s_i + s) / d bounds what is inside.
    """
    spark = scatter.sparkSession
    counts = {r.labeling: r["count"] for r in scatter.groupBy("labeling").count().collect()}
    trees = {}
    for labeling, n in counts.items():
        tree, wide = Splits(), np.full(len(middle), np.inf)
        blocks = -(-n // block_clusters)
        sample = np.zeros((0, len(middle)))
        if blocks > 1:
            share = min(1.0, blocks * SPLIT_SAMPLES / n)
            drawn = F.pmod(F.xxhash64("cluster"), F.lit(1 << 30)) < share * (1 << 30)
            sample = scatter.where((F.col("labeling") == labeling) & drawn).select(
                *middle
            ).toPandas().to_numpy(dtype=float)
        tree.grow(sample, blocks, -wide, wide, np.random.default_rng(0))
        trees[labeling] = tree
    sent = spark.sparkContext.broadcast(trees)
    fields = "labeling string, cluster int, scatter double, " + ", ".join(
        f"`{c}` double" for c in middle
    )
    kept = scatter.select("labeling", "cluster", "scatter", *middle)

    def by_labeling(batches, what):
        for batch in filter(len, batches):
            for labeling, rows in batch.groupby("labeling"):
                yield from what(sent.value[labeling], rows)

    def at_home(tree, rows):
        yield rows.assign(block=tree.locate(rows[middle].to_numpy(dtype=float)), home=True)

    homes = kept.mapInPandas(
        lambda batches: by_labeling(batches, at_home), fields + ", block bigint, home boolean"
    )

    def local(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.assign(worst=_overlaps(rows, rows, middle))[
            ["labeling", "cluster", "scatter", *middle, "block", "worst"]
        ]

    first = homes.groupBy("labeling", "block").applyInPandas(
        local, fields + ", block bigint, worst double"
    )
    if all(tree.blocks == 1 for tree in trees.values()):
        return first.select("labeling", "cluster", "worst")

    first = materialize(first, "worst")
    tops = {
        (r.labeling, r.block): r.top
        for r in first.groupBy("labeling", "block").agg(F.max("scatter").alias("top")).collect()
    }
    boxes = {}
    for labeling, tree in trees.items():
        leaves = [i for i, b in enumerate(tree.block) if b >= 0]
        boxes[labeling] = (
            np.array([tree.block[i] for i in leaves]), np.array([tree.low[i] for i in leaves]),
            np.array([tree.high[i] for i in leaves]),
            np.array([tops.get((labeling, tree.block[i]), -1.0) for i in leaves]),
        )
    sent_boxes = spark.sparkContext.broadcast(boxes)

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in filter(len, batches):
            for labeling, rows in batch.groupby("labeling"):
                block, low, high, top = sent_boxes.value[labeling]
                step = max(1, TILE_CELLS // (len(block) * len(middle)))
                for at in range(0, len(rows), step):
                    part = rows.iloc[at:at + step]
                    place = part[middle].to_numpy(dtype=float)[:, None, :]
                    apart = np.sqrt((np.maximum(np.maximum(low - place, place - high), 0) ** 2).sum(2))
                    most = part["scatter"].to_numpy()[:, None] + top
                    worst = part["worst"].to_numpy()[:, None]
                    # Bounds are taken up by more than their rounding.
                    could = (most * (1 + 1e-9) >= worst * apart) & (top >= 0)
                    could &= part["block"].to_numpy()[:, None] != block
                    who, where = np.nonzero(could)
                    yield part.iloc[who].assign(
                        labeling=np.full(len(who), labeling, dtype=object),
                        block=block[where], home=False,
                    )[
                        ["labeling", "cluster", "scatter", *middle, "block", "home"]
                    ]

    guests = first.mapInPandas(visit, fields + ", block bigint, home boolean")
    parts = -(-max(counts.values()) // MOST_GUESTS)
    spread_homes = homes.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    spread_guests = guests.withColumn("part", F.pmod(F.xxhash64("cluster"), F.lit(parts)).cast("int"))

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        here, there = rows[rows["home"]], rows[~rows["home"]]
        return pd.DataFrame({
            "labeling": there["labeling"].to_numpy(dtype=object), "cluster": there["cluster"].to_numpy(),
            "worst": _overlaps(there, here, middle),
        })

    beyond = spread_homes.unionByName(spread_guests).groupBy("labeling", "block", "part").applyInPandas(
        meet, "labeling string, cluster int, worst double"
    )
    return first.select("labeling", "cluster", "worst").union(beyond).groupBy(
        "labeling", "cluster"
    ).agg(F.max("worst").alias("worst"))


def silhouette_samples(
    points: DataFrame,
    columns: Sequence[str],
    labels: Sequence[str],
    id_col: str = "CustomerID",
    distance: str = "euclidean",
) -> DataFrame:
    """(b - a) / max(a, b) of every row that is no noise; 0 in a cluster of one.

    Columns: the id, labeling, cluster, silhouette, distance. ``distance`` is ``euclidean`` or
    ``squared``.
    """
    if distance == "squared":
        return _squared_samples(points, list(columns), list(labels), id_col)
    if distance != "euclidean":
        raise ValueError(f"distance must be euclidean or squared, not {distance!r}")
    columns, labels = list(columns), list(labels)
    sizes = materialize(
        long_labels(points, columns, labels).groupBy("labeling", "cluster")
        .agg(F.count("*").alias("n")),
        "sizes",
    )
    counts = {r.labeling: r["count"] for r in sizes.groupBy("labeling").count().collect()}
    # Labelings with few clusters share one pass; the others take one each.
    together, width = [], 0
    for name in sorted(labels, key=lambda name: counts.get(name, 0)):
        width += counts.get(name, 0)
        if width <= MOST_CLUSTERS:
            together.append(name)
    parts = [
        _by_blocks(points, columns, name, id_col, sizes.where(F.col("labeling") == name))
        for name in labels if name not in together
    ]
    if together:
        shared = [name for name in labels if name in together]
        known = sizes.where(F.col("labeling").isin(shared))
        parts.insert(0, _by_sums(points, columns, shared, id_col, known))
    return reduce(DataFrame.union, parts)


def _in_pairs(rows: DataFrame, block: Column, blocks: int, work, schema: str) -> DataFrame:
    """``work(one, other)`` for every unordered pair of blocks; a block meets itself as (one, None).

    Each row is sent once for every block, and every pair of rows is met once.
    """
    dealt = rows.withColumn("_block", block.cast("int")).withColumn(
        "_with", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    low, high = F.least("_block", "_with"), F.greatest("_block", "_with")
    # Pairs are numbered, so that each has a partition of its own: hashed ones would share some.
    dealt = dealt.withColumns({
        "_low": low, "_high": high,
        "_pair": (F.shiftright(high * (high + 1), 1) + low).cast("int"),
    }).drop("_with")
    pairs = blocks * (blocks + 1) // 2
    dealt = dealt.repartitionById(min(pairs, MOST_PARTITIONS), "_pair")

    def pair(rows: pd.DataFrame) -> pd.DataFrame:
        low = rows["_low"].iloc[0]
        first = rows["_block"].to_numpy() == low
        if low == rows["_high"].iloc[0]:
            return work(rows, None)
        one, other = rows[first], rows[~first]
        return work(one, other) if len(one) and len(other) else work(None, None)

    return dealt.groupBy("_pair").applyInPandas(pair, schema)


def _block_number(rows: int, cores: int, size: int) -> int:
    """Blocks of bounded size; for a small table enough that each core has some pairs of them."""
    least = min(3 * int(np.ceil(np.sqrt(cores))), -(-rows // FEWEST_ROWS))
    return max(1, least, -(-rows // size))


class _Packed:
    """A record of packed rows, sorted by their clusters, and their sums of distances to each."""

    def __init__(self, values, labels, width: int, columns: int, places):
        self.labels = np.frombuffer(labels, dtype=np.int32).reshape(-1, len(places.labels))
        self.values = np.frombuffer(values).reshape(-1, columns)
        self.kinds = _Kinds(places.columns_of(self.labels), width)
        self.cuts = self.kinds.cuts()
        # A row of sums for each cluster.
        self.sums = np.zeros((width, len(self.values)))

    def meet(self, other: _Packed) -> None:
        """Every row of the one with every row of the other; a record meets itself as itself."""
        mirrored = other is self
        tiles = plane_tiles(self.values, other.values, mirrored, self.cuts, other.cuts)
        for rows, cols, gaps in tiles:
            other.kinds.add(self.sums[:, rows], cols, gaps.T)
            if not mirrored or rows.start != cols.start:
                self.kinds.add(other.sums[:, cols], rows, gaps)


@dataclass
class _Places:
    """Where in an array of sums the clusters of a row stand.

    There is a sum for each cluster of each labeling, or, if they are fewer, for each ``kinds``, the
    combinations of labels that occur.
    """

    labels: list[str]
    clusters: dict[str, tuple[np.ndarray, np.ndarray]]
    kinds: list[tuple[int, ...]] | None = None

    def __post_init__(self):
        self.starts, self.clusters_width = {}, 0
        for name in self.labels:
            if name in self.clusters:
                self.starts[name] = self.clusters_width
                self.clusters_width += len(self.clusters[name][0])

    @property
    def width(self) -> int:
        return self.clusters_width if self.kinds is None else len(self.kinds)

    def of_clusters(self, labels: np.ndarray) -> np.ndarray:
        """The place of each label's cluster; -1 for noise."""
        out = np.full((len(labels), len(self.starts)), -1)
        for i, (name, start) in enumerate(self.starts.items()):
            own = labels[:, self.labels.index(name)]
            counted = np.flatnonzero(own != -1)
            out[counted, i] = start + np.searchsorted(self.clusters[name][0], own[counted])
        return out

    def columns_of(self, labels: np.ndarray) -> np.ndarray:
        if self.kinds is None:
            return self.of_clusters(labels)
        known = {kind: i for i, kind in enumerate(self.kinds)}
        found, at = np.unique(labels, axis=0, return_inverse=True)
        return np.array([known[tuple(kind)] for kind in found.tolist()], dtype=int)[at.reshape(-1, 1)]

    def to_clusters(self, sums: np.ndarray) -> np.ndarray:
        """Sums for each cluster, a row for each of the rows."""
        if self.kinds is None:
            return sums.T
        held = np.zeros((len(self.kinds), self.clusters_width))
        places = self.of_clusters(np.array(self.kinds, dtype=np.int32).reshape(-1, len(self.labels)))
        kind, label = np.nonzero(places >= 0)
        held[kind, places[kind, label]] = 1.0
        return sums.T @ held


def _by_sums(points, columns, labels, id_col, sizes) -> DataFrame:
    """With few clusters: sums over all clusters for each row and block.

    Rows are packed into records of some thousands, and each block of records is a partition. Two
    blocks meet in a task of a product of partitions, which reads them and shuffles neither: it
    streams the records of the one and holds those of the other. Only sums leave a task.
    """
    found = sizes.toPandas().sort_values(["labeling", "cluster"])
    places = _Places(labels, {
        name: (own["cluster"].to_numpy(), own["n"].to_numpy(dtype=float))
        for name, own in found.groupby("labeling")
    })
    kind = points.schema[id_col].dataType.simpleString()
    values, tags = [f"_x{i}" for i in range(len(columns))], [f"_l{i}" for i in range(len(labels))]
    rows = points.select(
        F.col(id_col).alias("_id"),
        *[F.col(c).cast("double").alias(x) for c, x in zip(columns, values)],
        *[F.coalesce(F.col(c).cast("int"), F.lit(-1)).alias(t) for c, t in zip(labels, tags)],
    ).where(reduce(Column.__or__, [F.col(t) != -1 for t in tags]))
    kinds = rows.select(*tags).distinct().limit(places.width + 1).collect()
    if len(kinds) < places.width:
        places.kinds = sorted(tuple(r) for r in kinds)
    width = places.width
    cores = points.sparkSession.sparkContext.defaultParallelism
    size = max(1, min(BLOCK_ROWS, BLOCK_SUMS // max(width, 1)))
    blocks = _block_number(rows.count(), cores, size)

    # Rows of one id and the same labels get one silhouette, so they stay in one record.
    keyed = rows.withColumns({
        "_block": F.pmod(F.xxhash64("_id"), F.lit(blocks)).cast("int"),
        "_key": F.xxhash64("_id", *tags),
    })

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = 0, None
        for batch in chain(batches, [None]):
            if batch is not None:
                table = pa.Table.from_batches([batch])
                held = table if held is None else pa.concat_tables([held, table])
            if held is None or (batch is not None and len(held) <= 2 * PACK_ROWS):
                continue
            ends = np.flatnonzero(np.diff(held["_key"].to_numpy())) + 1
            at = 0
            while at < len(held):
                past = np.searchsorted(ends, at + PACK_ROWS)
                end = int(ends[past]) if past < len(ends) else len(held)
                if end == len(held) and batch is not None:
                    break
                yield record(held.slice(at, end - at).combine_chunks(), part)
                at, part = end, part + 1
            held = held.slice(at)

    def record(table: pa.Table, part: int) -> pa.RecordBatch:
        data = np.column_stack([table[x].to_numpy() for x in values])
        tagged = np.column_stack([table[t].to_numpy() for t in tags]).astype(np.int32)
        # Rows with the same labels lie together, so a tile holds few kinds of rows, and among
        # them those as far from the middle.
        order = np.lexsort([_far(pd.DataFrame(data)), *tagged.T])
        ids = table["_id"].take(pa.array(order)).combine_chunks()
        return pa.record_batch({
            "block": pa.array([table["_block"][0].as_py()], pa.int32()),
            "part": pa.array([part], pa.int32()),
            "data": pa.array([data[order].tobytes()], pa.binary()),
            "tags": pa.array([tagged[order].tobytes()], pa.binary()),
            "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
        })

    packed = materialize(
        keyed.repartitionById(blocks, "_block").sortWithinPartitions(*tags, "_key").mapInArrow(
            pack, f"block int, part int, data binary, tags binary, ids array<{kind}>"
        ), "packed",
    )
    sides = [
        packed.select(*[F.col(c).alias(f"{side}_{c}") for c in ("block", "part", "data", "tags")])
        .repartitionById(blocks, F.col(f"{side}_block"))
        for side in ("one", "other")
    ]
    first = F.col("one_block") < F.col("other_block")
    same = F.col("one_block") == F.col("other_block")
    # The hint keeps a small table from being sent whole to tasks that are too few.
    pairs = sides[0].hint("shuffle_replicate_nl").join(
        sides[1], first | (same & (F.col("one_part") <= F.col("other_part")))
    )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def unpack(batch: pa.RecordBatch, side: str, i: int) -> _Packed:
            data, tagged = (
                bytes(batch.column(f"{side}_{c}")[i].as_buffer()) for c in ("data", "tags")
            )
            return _Packed(data, tagged, width, len(columns), places)

        def sums(block: int, part: int, source: int, side: _Packed) -> pa.RecordBatch:
            return pa.record_batch({
                "block": pa.array([block], pa.int32()), "part": pa.array([part], pa.int32()),
                "source": pa.array([source], pa.int32()),
                "sums": pa.array([side.sums.tobytes()], pa.binary()),
            })

        one, at, others = None, None, {}
        for batch in batches:
            numbers = zip(*(
                batch.column(c).to_pylist()
                for c in ("one_block", "one_part", "other_block", "other_part")
            ))
            for i, (block, part, other_block, other_part) in enumerate(numbers):
                key = other_block, other_part
                if key not in others:
                    others[key] = unpack(batch, "other", i)
                if at != (block, part):
                    if one is not None:
                        yield sums(*at, 2 * to, one)
                    one, at, to = unpack(batch, "one", i), (block, part), other_block
                if key == at:
                    others[key].meet(others[key])
                else:
                    one.meet(others[key])
        if one is not None:
            yield sums(*at, 2 * to, one)
        for key, other in others.items():
            yield sums(*key, 2 * at[0] + 1, other)

    met = pairs.mapInArrow(meet, "block int, part int, source int, sums binary")

    def finish(table: pa.Table) -> pa.Table:
        head = table.filter(pc.equal(table["source"], -1))
        table = table.filter(pc.not_equal(table["source"], -1)).sort_by("source")
        tagged = np.frombuffer(head["tags"][0].as_buffer(), dtype=np.int32).reshape(-1, len(tags))
        total = np.zeros((width, len(tagged)))
        for part in table["sums"]:
            total += np.frombuffer(part.as_buffer()).reshape(total.shape)
        total = places.to_clusters(total)
        ids = pa.chunked_array([head["ids"].combine_chunks().flatten()]).combine_chunks()
        codes = ids.dictionary_encode(null_encoding="encode").indices.to_numpy()
        _, begin, of = np.unique(
            np.column_stack([codes, tagged]), axis=0, return_index=True, return_inverse=True
        )
        if len(begin) < len(codes):
            merged = np.zeros((len(begin), total.shape[1]))
            np.add.at(merged, of.reshape(-1), total)
            total, tagged, ids = merged, tagged[begin], ids.take(pa.array(begin))
        out = []
        for name, start in places.starts.items():
            known, n = places.clusters[name]
            label = tagged[:, labels.index(name)]
            counted = np.flatnonzero(label != -1)
            widths = _widths(
                total[counted, start:start + len(known)], n, np.searchsorted(known, label[counted])
            )
            out.append(pa.table({
                id_col: ids.take(pa.array(counted)), "labeling": pa.array([name] * len(counted), pa.string()),
                "cluster": label[counted], "silhouette": widths,
                "distance": pa.array(["euclidean"] * len(counted), pa.string()),
            }))
        return pa.concat_tables(out)

    heads = packed.select("block", "part", F.lit(-1).alias("source"), "tags", "ids")
    return met.unionByName(heads, allowMissingColumns=True).groupBy("block", "part").applyInArrow(
        finish, _SAMPLES.format(id_col, kind)
    )


class _Kinds:
    """Rows, sorted by their clusters, as runs of rows that are in the same clusters."""

    def __init__(self, clusters: np.ndarray, width: int):
        new = np.any(clusters[1:] != clusters[:-1], axis=1)
        self.edges = np.concatenate([[0], np.flatnonzero(new) + 1, [len(clusters)]])
        self.clusters, self.width = clusters, width
        self.runs = [own[own >= 0] for own in clusters[self.edges[:-1]]] if len(clusters) else []

        self.plans: dict[int, tuple] = {}

    def _plan(self, part: slice) -> tuple:
        """What sums a tile: its one run's clusters, or runs and which of them are in a cluster, or,
        with many runs, the clusters of each row as a matrix."""
        first = np.searchsorted(self.edges, part.start, side="right") - 1
        last = np.searchsorted(self.edges, part.stop, side="left")
        if last - first == 1:
            return "one", np.ones(part.stop - part.start), self.runs[first].tolist()
        if last - first > MOST_RUNS:
            belongs = np.zeros((self.width, part.stop - part.start))
            row, label = np.nonzero(self.clusters[part] >= 0)
            belongs[self.clusters[part][row, label], row] = 1.0
            return "rows", belongs, None
        begin = np.maximum(self.edges[first:last], part.start) - part.start
        inside = np.zeros((last - first, part.stop - part.start))
        inside[np.searchsorted(begin, np.arange(inside.shape[1]), side="right") - 1,
               np.arange(inside.shape[1])] = 1.0
        held = np.zeros((self.width, last - first))
        for run in range(first, last):
            held[self.runs[run], run - first] = 1.0
        return "runs", (begin, inside), held

    def add(self, sums: np.ndarray, part: slice, gaps: np.ndarray) -> None:
        """Add ``gaps``, a row for each of the rows ``part``, to the sums of their clusters."""
        if part.start not in self.plans:
            self.plans[part.start] = self._plan(part)
        plan, what, held = self.plans[part.start]
        if plan == "one":
            total = what @ gaps
            for cluster in held:
                sums[cluster] += total
        elif plan == "rows":
            sums += what @ gaps
        elif gaps.flags.c_contiguous:
            sums += held @ (what[1] @ gaps)
        else:
            # Rows of a transposed tile lie side by side, and adding up is faster than a product.
            sums += held @ np.add.reduceat(gaps, what[0], axis=0)

    def cuts(self) -> list[slice]:
        """Slices of bounded size; a long run has slices of its own, short ones share them."""
        long = np.flatnonzero(np.diff(self.edges) >= RUN_ROWS)
        ends = np.unique(np.concatenate([[0, self.edges[-1]], self.edges[long], self.edges[long + 1]]))
        return [
            cut for start, stop in zip(ends.tolist(), ends[1:].tolist())
            for cut in even_cuts(stop - start, start)
        ]


def _far(data: pd.DataFrame) -> np.ndarray:
    """A squared distance from the middle that only orders rows."""
    with np.errstate(over="ignore", invalid="ignore"):
        return ((data - data.median()) ** 2).sum(axis=1).to_numpy()


_SAMPLES = "`{}` {}, labeling string, cluster int, silhouette double, distance string"


def _widths(total: np.ndarray, n: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Silhouettes from sums of distances to each cluster, its size, and the own cluster."""
    here = np.arange(len(own))
    a = total[here, own] / np.maximum(n[own] - 1, 1)
    means = total / n
    means[here, own] = np.inf
    b = means.min(axis=1, initial=np.inf)
    top = np.maximum(a, b)
    out = np.zeros(len(own))
    fit = (n[own] > 1) & np.isfinite(b) & (top > 0)
    out[fit] = (b - a)[fit] / top[fit]
    return out


def _by_blocks(points, columns, name, id_col, sizes) -> DataFrame:
    """With many clusters: a block holds whole clusters, or a part of one large cluster.

    For each row and block one row comes back: the sum over the own cluster, the least mean of
    whole other clusters, or the sum over the part of a large one.
    """
    kind = points.schema[id_col].dataType.simpleString()
    large = {
        r.cluster: -(-r.n // PAIR_ROWS) for r in sizes.where(F.col("n") > PAIR_ROWS).collect()
    }
    rest = sizes.where(F.col("n") <= PAIR_ROWS).agg(F.sum("n")).first()[0] or 0
    cores = points.sparkSession.sparkContext.defaultParallelism
    small = _block_number(rest, cores, PAIR_ROWS)
    blocks, block = small, F.pmod(F.xxhash64("cluster"), F.lit(small))
    for cluster, parts in large.items():
        part = F.pmod(F.xxhash64(id_col), F.lit(parts)) + F.lit(blocks)
        block = F.when(F.col("cluster") == cluster, part).otherwise(block)
        blocks += parts
    rows = points.select(
        id_col, *columns, F.col(name).cast("int").alias("cluster")
    ).where(F.col("cluster") != -1).join(sizes.select("cluster", "n"), "cluster")

    def toward(gaps: np.ndarray, rows: pd.DataFrame, others: pd.DataFrame, axis: int = 1) -> dict:
        """What each of ``rows`` learns of the clusters of ``others``, sorted by cluster.

        The others lie along ``axis`` of ``gaps``.
        """
        known, first, held = np.unique(
            others["cluster"].to_numpy(), return_index=True, return_counts=True
        )
        own = rows["cluster"].to_numpy()
        sums = np.add.reduceat(gaps, first, axis=axis)
        sums = sums if axis else sums.T
        whole = others["n"].to_numpy()[first] == held
        at = np.searchsorted(known, own)
        at[at == len(known)] = 0
        mine = known[at] == own
        here = np.arange(len(own))
        means = np.where(whole, sums / held, np.inf)
        means[here[mine], at[mine]] = np.inf
        part = np.flatnonzero(~whole)
        none = np.full(len(own), np.nan)
        # At most one cluster of a block is a part of a larger one, and then the only one.
        split = len(part) > 0
        return {
            "own": np.where(mine, sums[here, at], 0.0), "best": means.min(axis=1),
            "other": known[part[0]] if split else -1,
            "toward": np.where(mine, np.nan, sums[:, part[0]]) if split else none,
        }

    def work(one, other) -> pd.DataFrame:
        out = []
        if one is not None:
            one = one.sort_values("cluster")
            other = None if other is None else other.sort_values("cluster")
            last = one if other is None else other
            gaps = np.empty((len(one), len(last)))
            tiles = plane_tiles(
                one[columns].to_numpy(dtype=float), last[columns].to_numpy(dtype=float)
            )
            for rows, cols, apart in tiles:
                gaps[rows, cols] = apart
            for side, met, axis in ((one, last, 1), (other, one, 0)):
                if side is not None:
                    out.append(pd.DataFrame({
                        id_col: _plain(side[id_col]), "cluster": side["cluster"].to_numpy(),
                        **toward(gaps, side, met, axis),
                    }))
        names = [id_col, "cluster", "own", "best", "other", "toward"]
        if not out:
            return pd.DataFrame(columns=names)
        return pd.DataFrame({
            c: np.concatenate([_plain(part[c]) for part in out]) for c in names
        })

    schema = f"`{id_col}` {kind}, cluster int, own double, best double, other int, toward double"
    met = materialize(_in_pairs(rows, block, blocks, work, schema), "met")
    sized = sizes.select("cluster", "n")
    parts = met.where(F.col("toward").isNotNull() & ~F.isnan("toward")).groupBy(id_col, "other").agg(
        F.sum("toward").alias("toward")
    ).join(sized.withColumnRenamed("cluster", "other"), "other").groupBy(id_col).agg(
        F.min(F.col("toward") / F.col("n")).alias("apart")
    )
    scored = met.groupBy(id_col, "cluster").agg(
        F.sum("own").alias("own"), F.min("best").alias("best")
    ).join(parts, id_col, "left").join(sized, "cluster")
    a = F.try_divide(F.col("own"), F.col("n") - 1)
    b = F.least("best", F.coalesce("apart", F.lit(float("inf"))))
    value = F.when(
        (F.col("n") > 1) & (b < float("inf")), F.try_divide(b - a, F.greatest(a, b))
    )
    return scored.select(
        id_col, F.lit(name).alias("labeling"), "cluster",
        F.coalesce(value, F.lit(0.0)).alias("silhouette"), F.lit("euclidean").alias("distance"),
    )


def _plain(column: pd.Series) -> np.ndarray:
    return column.to_numpy(dtype=None if column.dtype.kind in "iuf" else object)


def _squared_samples(points, columns, labels, id_col) -> DataFrame:
    """The same for squared distances: the mean to a cluster is |x - mean|^2 + inner variance.

    The labels lie on the row and the clusters of one labeling fit into a task, so each row is
    finished in the scan: nothing is shuffled and no row is copied per cluster.
    """
    centers = materialize(cluster_centers(points, columns, labels), "centers")
    kind = points.schema[id_col].dataType.simpleString()
    if centers.count() > MOST_CENTERS:
        return _squared_in_blocks(points, columns, labels, id_col, centers)
    plan = {
        name: (
            own["cluster"].to_numpy(), own["n"].to_numpy(dtype=float),
            own[[f"m_{c}" for c in columns]].to_numpy(dtype=float),
            own["within"].to_numpy(dtype=float),
        )
        for name, own in centers.toPandas().sort_values("cluster").groupby("labeling")
    }
    sent = points.sparkSession.sparkContext.broadcast(plan)

    def finish(batches):
        for batch in batches:
            data = batch[columns].to_numpy(dtype=float)
            for name in labels:
                label = batch[name].to_numpy()
                counted = np.flatnonzero(label != -1)
                if name not in sent.value or not len(counted):
                    continue
                clusters, n, means, within = sent.value[name]
                value = np.zeros(len(counted))
                for at, squares in _square_tiles(data[counted], means):
                    own = np.searchsorted(clusters, label[counted[at]])
                    value[at] = _widths(squares * n + within, n, own)
                yield pd.DataFrame({
                    id_col: _plain(batch[id_col])[counted], "labeling": name,
                    "cluster": label[counted].astype("int32"), "silhouette": value,
                    "distance": "squared",
                })

    return points.select(id_col, *columns, *labels).mapInPandas(
        finish, _SAMPLES.format(id_col, kind)
    )


def _square_tiles(data: np.ndarray, means: np.ndarray):
    for at, gaps in distance_tiles(data, means):
        yield at, gaps * gaps


def _squared_in_blocks(points, columns, labels, id_col, centers) -> DataFrame:
    """The same when the centres are too many to send to every task: blocks of both meet."""
    middle = [f"m_{c}" for c in columns]
    rows = long_labels(points, columns, labels).select(id_col, "labeling", "cluster", *columns)
    others = centers.select("labeling", F.col("cluster").alias("other"), "n", "within", *middle)
    kind = points.schema[id_col].dataType.simpleString()

    def work(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        own, best = np.full(len(left), np.nan), np.empty(len(left))
        n, within = right["n"].to_numpy(dtype=float), right["within"].to_numpy(dtype=float)
        label, other = left["cluster"].to_numpy(), right["other"].to_numpy()
        for at, squares in _square_tiles(
            left[columns].to_numpy(dtype=float), right[middle].to_numpy(dtype=float)
        ):
            total = squares * n + within
            row, col = np.nonzero(label[at, None] == other)
            own[np.arange(len(left))[at][row]] = total[row, col]
            total[row, col] = np.inf
            best[at] = (total / n).min(axis=1)
        return pd.DataFrame({
            id_col: _plain(left[id_col]), "labeling": left["labeling"].to_numpy(dtype=object),
            "cluster": label, "own": own, "best": best,
        })

    met = meet_in_blocks(
        rows.withColumn("_row", F.col(id_col)), others.withColumn("_row", F.col("other")),
        ["labeling"], "_row", work,
        f"`{id_col}` {kind}, labeling string, cluster int, own double, best double",
    )
    scored = met.groupBy(id_col, "labeling", "cluster").agg(
        F.max(F.nanvl("own", F.lit(None))).alias("own"), F.min("best").alias("best")
    ).join(centers.select("labeling", "cluster", "n"), ["labeling", "cluster"])
    a, b = F.try_divide(F.col("own"), F.col("n") - 1), F.col("best")
    value = F.when(
        (F.col("n") > 1) & (b < float("inf")), F.try_divide(b - a, F.greatest(a, b))
    )
    return scored.select(
        id_col, "labeling", "cluster", F.coalesce(value, F.lit(0.0)).alias("silhouette"),
        F.lit("squared").alias("distance"),
    )


def silhouette_score(samples: DataFrame) -> DataFrame:
    return samples.groupBy("labeling").agg(F.avg("silhouette").alias("silhouette"))


def all_metrics(
    points: DataFrame, columns: Sequence[str], labels: Sequence[str], id_col: str = "CustomerID",
    distance: str = "euclidean",
) -> DataFrame:
    """One row per label column: clusters, silhouette, CH, DB and inner sum of squares."""
    centers = materialize(cluster_centers(points, columns, labels), "centers")
    sums = centers.groupBy("labeling").agg(
        F.count("*").cast("int").alias("n_clusters"), F.sum("within").alias("wcss")
    )
    silhouettes = silhouette_score(
        silhouette_samples(points, columns, labels, id_col, distance)
    )
    return (
        sums.join(silhouettes, "labeling", "left")
        .join(_variance_ratio(centers, columns), "labeling", "left")
        .join(_davies_bouldin(points, columns, labels, centers), "labeling", "left")
        .select(
            "labeling", "n_clusters", "silhouette", "calinski_harabasz", "davies_bouldin", "wcss"
        )
    )
