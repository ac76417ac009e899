"""DBSCAN (Ester et al., 1996), exact, in blocks.

Equal points are merged first and carry their number as weight, so a heap of copies is one point.
A tree of splits, taken from a sample of the points and not from the range of their values, cuts
them into blocks of bounded size. A point visits the blocks whose box is within the radius.

Inside its block, points that lie within half the radius of their mean are a tight group: any two
of them are neighbours. A group of ``min_samples`` or more needs no counting, all its points are
core and belong together, so a heap of distinct points within the radius is a few groups. Only the
other, open points are counted. Two tight groups are linked if one of a few points of the one is
near a point of the other; only where none is, all points of the two meet.

Neighbours are only counted or merged inside a task: what leaves it are counts per point and links
between groups and open points, never the pairs of points.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.constants import DBSCAN_EPS, DBSCAN_MIN_SAMPLES
from clientele.functions.agglomerate import SPLIT_SAMPLES, Splits
from clientele.functions.blocks import MOST_PARTITIONS, distance_tiles, within_tiles
from clientele.functions.components import connected_components
from clientele.functions.labels import renumber
from clientele.storage import materialize

#: Points of a block, and points for which one task compares a block with all its visitors.
BLOCK_POINTS = 1_000
PART_POINTS = 100_000
#: Blocks that share a task at most.
JOINT_BLOCKS = 16
#: Points of a tight group that stand for it when it visits.
ENVOYS = 8


def merged_points(points: DataFrame, columns: Sequence[str], id_col: str) -> DataFrame:
    """Distinct points with their number of rows and least id."""
    return materialize(
        points.groupBy(*columns).agg(
            F.min(id_col).alias("_rep"), F.count("*").cast("double").alias("_weight")
        ),
        "merged",
    )


class _ToBox:
    """Squared distance to a box, as the tree of splits asks for it."""

    @staticmethod
    def box_gap(weights, places, low, high, least):
        apart = np.maximum(np.maximum(low - places, places - high), 0.0)
        return (apart * apart).sum(axis=1)


def _visited(tree: Splits, places: np.ndarray, reach: np.ndarray):
    """(rows, blocks): the blocks within ``reach`` of each place, its own too."""
    rows, blocks, _ = tree.visits(
        places, np.ones(len(places)), reach * reach, np.full(len(places), -1), _ToBox, 1.0
    )
    return rows, blocks


def tight_groups(data: np.ndarray, radius: float) -> np.ndarray:
    """Group numbers: halves of halves, until all points of one lie within ``radius`` of its mean."""
    group = np.empty(len(data), dtype=np.int64)
    stack, found = [np.arange(len(data))], 0
    while stack:
        rows = stack.pop()
        part = data[rows]
        apart = part - part.mean(axis=0)
        # Taken down by more than its rounding, so that members are surely neighbours.
        if len(rows) < 2 or np.sqrt((apart * apart).sum(axis=1).max()) <= radius * (1 - 1e-9):
            group[rows] = found
            found += 1
            continue
        order = np.argsort(part[:, np.ptp(part, axis=0).argmax()], kind="stable")
        half = len(rows) // 2
        stack += [rows[order[:half]], rows[order[half:]]]
    return group


class _Density:
    """Merged points in blocks (_rep, _weight, *columns, _block, _group), stored."""

    def __init__(self, merged: DataFrame, columns: Sequence[str], eps: float, min_samples: int,
                 id_type, block_points: int):
        self.columns, self.eps = list(columns), float(eps)
        self.kind = id_type.simpleString()
        rows = merged.count()
        blocks = max(1, -(-rows // block_points))
        tree, wide = Splits(), np.full(len(self.columns), np.inf)
        sample = np.zeros((0, len(self.columns)))
        if blocks > 1:
            share = min(1.0, blocks * SPLIT_SAMPLES / rows)
            drawn = F.pmod(F.xxhash64("_rep"), F.lit(1 << 30)) < share * (1 << 30)
            sample = merged.where(drawn).select(*self.columns).toPandas().to_numpy(dtype=float)
        tree.grow(sample, blocks, -wide, wide, np.random.default_rng(0))
        self.blocks, self.rows = tree.blocks, rows
        # Blocks that lie side by side share a task, as long as every core has several of them.
        cores = merged.sparkSession.sparkContext.defaultParallelism
        self.joint = max(1, min(JOINT_BLOCKS, self.blocks // (3 * cores)))
        self.sent = merged.sparkSession.sparkContext.broadcast(tree)
        fields = f"_rep {self.kind}, _weight double, " + ", ".join(
            f"`{c}` double" for c in self.columns
        )
        self.fields = fields + f", _block bigint, _group {self.kind}"
        columns, sent, radius = self.columns, self.sent, self.eps / 2

        def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in filter(len, batches):
                yield batch.assign(_block=sent.value.locate(batch[columns].to_numpy(dtype=float)))

        def group(rows: pd.DataFrame) -> pd.DataFrame:
            number = tight_groups(rows[columns].to_numpy(dtype=float), radius)
            heavy = np.bincount(number, rows["_weight"].to_numpy()) >= min_samples
            least = rows["_rep"].groupby(number).min()
            name = np.full(len(rows), None, dtype=object)
            inside = heavy[number]
            name[inside] = least.to_numpy(dtype=object)[number[inside]]
            return rows.assign(_group=pd.Series(name, index=rows.index, dtype=object))

        placed = merged.select("_rep", "_weight", *columns).mapInPandas(
            place, fields + ", _block bigint"
        ).repartition(min(2 * blocks, MOST_PARTITIONS), "_block")
        self.points = materialize(
            placed.groupBy("_block").applyInPandas(group, self.fields), "placed"
        )

    def met(self, guests: DataFrame, homes: DataFrame, work, schema: str) -> DataFrame:
        """``work(guests, homes)`` for each block; ``guests`` have ``_reach``, both the same rest.

        A guest is sent once to all of the blocks of a task, with a bit for each one it visits.
        """
        columns, sent, joint = self.columns, self.sent, self.joint
        tasks = -(-self.blocks // joint)

        def visited(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """(rows, tasks, bits of the blocks there)."""
            rows, blocks = _visited(
                sent.value, batch[columns].to_numpy(dtype=float), batch["_reach"].to_numpy()
            )
            key = rows * tasks + blocks // joint
            order = np.argsort(key, kind="stable")
            key, begin = np.unique(key[order], return_index=True)
            bits = (1 << (blocks % joint))[order]
            return key // tasks, key % tasks, np.bitwise_or.reduceat(bits, begin) if len(key) else bits

        def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in filter(len, batches):
                rows, to, bits = visited(batch)
                if len(rows):
                    yield batch.iloc[rows].assign(_block=to, _bits=bits)

        def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in filter(len, batches):
                to, n = np.unique(visited(batch)[1], return_counts=True)
                yield pd.DataFrame({"_block": to, "n": n})

        # Only a crowded task is cut: its homes are sent to every part of it.
        crowded = {}
        if self.rows > PART_POINTS:
            crowded = {
                r["_block"]: -(-r["n"] // PART_POINTS)
                for r in guests.select(*columns, "_reach").mapInPandas(
                    tally, "_block bigint, n bigint"
                ).groupBy("_block").agg(F.sum("n").alias("n")).where(F.col("n") > PART_POINTS).collect()
            }
        parts = F.lit(1)
        if crowded:
            table = F.create_map(*[
                F.lit(x).cast(t) for pair in crowded.items() for x, t in zip(pair, ("long", "int"))
            ])
            parts = F.coalesce(table[F.col("_block")], parts)

        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in guests.schema)
        moved = guests.mapInPandas(visit, fields + ", _bits bigint").withColumn(
            "_part", F.pmod(F.xxhash64("_rep"), parts).cast("int")
        )
        stay = homes.withColumns({
            "_reach": F.lit(-1.0),
            "_bits": F.expr(f"shiftleft(1L, CAST(_block % {joint} AS INT))"),
            "_block": F.expr(f"_block DIV {joint}"),
        }).withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))

        def meet(rows: pd.DataFrame) -> pd.DataFrame:
            own, bits = rows["_reach"].to_numpy() < 0, rows["_bits"].to_numpy()
            found = []
            for block in range(joint):
                here = (bits >> block) & 1 == 1
                if (here & own).any() and (here & ~own).any():
                    found.append(work(rows[here & ~own], rows[here & own]))
            found = [part for part in found if len(part)]
            return pd.concat(found) if found else work(rows.iloc[:0], rows.iloc[:0])

        every = stay.unionByName(moved, allowMissingColumns=True).repartition(
            min(2 * (tasks + sum(crowded.values())), MOST_PARTITIONS), "_block", "_part"
        )
        return every.groupBy("_block", "_part").applyInPandas(meet, schema)

    def counts(self, guests: DataFrame) -> DataFrame:
        """(_rep, neighbors) of ``guests``, the weights within the radius."""
        columns, eps = self.columns, self.eps

        def count(guests: pd.DataFrame, homes: pd.DataFrame) -> pd.DataFrame:
            near = np.zeros(len(guests))
            weights = homes["_weight"].to_numpy()
            tiles = within_tiles(_values(guests, columns), _values(homes, columns), eps)
            for rows, within in tiles:
                near[rows] = within @ weights
            return pd.DataFrame({"_rep": _reps(guests), "near": near})

        partial = self.met(
            guests.withColumn("_reach", F.lit(eps)), self.points, count, f"_rep {self.kind}, near double"
        )
        return partial.groupBy("_rep").agg(F.sum("near").cast("bigint").alias("neighbors"))

    def links(self, flagged: DataFrame) -> DataFrame:
        """(_rep, _node): open points and the nodes of core points near them.

        A node is a tight group, by its name, or an open core point. ``flagged`` has is_core.
        """
        columns, eps = self.columns, self.eps

        def link(guests: pd.DataFrame, homes: pd.DataFrame) -> pd.DataFrame:
            homes, nodes, first = _sorted_by(homes, "_node")
            names, found = _reps(guests), []
            tiles = within_tiles(_values(guests, columns), _values(homes, columns), eps)
            for rows, within in tiles:
                i, j = np.nonzero(np.logical_or.reduceat(within, first, axis=1))
                found.append(np.column_stack([i + rows.start, j]))
            pairs = np.concatenate(found) if found else np.zeros((0, 2), dtype=np.int64)
            return pd.DataFrame({"_rep": names[pairs[:, 0]], "_node": nodes[pairs[:, 1]]})

        core = flagged.where("is_core").withColumn("_node", F.coalesce("_group", "_rep"))
        guests = flagged.where(F.col("_group").isNull()).withColumn("_reach", F.lit(eps))
        return self.met(
            guests.withColumn("_node", F.lit(None).cast(self.kind)), core, link,
            f"_rep {self.kind}, _node {self.kind}",
        )

    def group_links(self, known: DataFrame | None = None) -> DataFrame:
        """(_rep, _node): links that join all tight groups with points within the radius of others.

        ``known`` are links between nodes that hold already; what they join stays joined.
        """
        columns, eps, kind = self.columns, self.eps, self.kind
        members = self.points.where(F.col("_group").isNotNull())

        def gather(rows: pd.DataFrame) -> pd.DataFrame:
            """A few points of each group of a block, with the reach of all of them."""
            out = []
            for name, own in rows.groupby("_group", sort=False):
                data = _values(own, columns)
                apart = np.sqrt(((data - data.mean(axis=0)) ** 2).sum(axis=1))
                # The members farthest out look to different sides; the reach is theirs to all.
                few = own.iloc[np.argsort(-apart, kind="stable")[:ENVOYS]]
                places = _values(few, columns)
                reach = [np.sqrt(((data - x) ** 2).sum(axis=1).max()) + eps for x in places]
                out.append(few.assign(_reach=np.array(reach) * (1 + 1e-9)))
            return pd.concat(out)

        envoys = members.repartition(min(2 * self.blocks, MOST_PARTITIONS), "_block").groupBy(
            "_block"
        ).applyInPandas(gather, self.fields + ", _reach double")

        def decide(guests: pd.DataFrame, homes: pd.DataFrame) -> pd.DataFrame:
            guests, one, begin = _sorted_by(guests, "_group")
            homes, two, first = _sorted_by(homes, "_group")
            least = [np.zeros((0, len(two)))]
            for _, gaps in distance_tiles(_values(guests, columns), _values(homes, columns)):
                least.append(np.minimum.reduceat(gaps, first, axis=1))
            least, reach = np.concatenate(least), guests["_reach"].to_numpy()
            near = np.logical_or.reduceat(least <= eps, begin, axis=0)
            # Beyond an envoy's reach no member of its group is within the radius.
            could = np.logical_and.reduceat(least <= reach[:, None], begin, axis=0)
            i, j = np.nonzero(near | could)
            apart = one[i] != two[j]
            i, j = i[apart], j[apart]
            return pd.DataFrame({"_rep": one[i], "_node": two[j], "linked": near[i, j]})

        found = materialize(self.met(
            envoys, members, decide, f"_rep {kind}, _node {kind}, linked boolean"
        ).groupBy(
            F.least("_rep", "_node").alias("_rep"), F.greatest("_rep", "_node").alias("_node")
        ).agg(F.max("linked").alias("linked")), "groups")

        linked = found.where("linked").select("_rep", "_node")
        joined = materialize(connected_components(
            linked if known is None else linked.union(known), "_rep", "_node"
        ), "joined")
        # Groups that no envoy could tell apart or link: all their points meet, unless other
        # links join the two already, when one more changes nothing.
        open_ = found.where(~F.col("linked")).select("_rep", "_node")
        for side in ("_rep", "_node"):
            open_ = open_.join(
                joined.select(F.col("vertex").alias(side), F.col("component").alias(f"{side}_in")),
                side, "left",
            )
        open_ = materialize(open_.where(
            F.coalesce("_rep_in", "_rep") != F.coalesce("_node_in", "_node")
        ).select("_rep", "_node"), "open")
        named = members.select(F.col("_group").alias("_name"), *columns)
        sides = [
            open_.join(named, open_[side] == named["_name"]).select(
                "_rep", "_node", *columns, F.lit(side == "_rep").alias("_first")
            ) for side in ("_rep", "_node")
        ]

        def close(rows: pd.DataFrame) -> pd.DataFrame:
            first = rows["_first"].to_numpy()
            one, other = _values(rows[first], columns), _values(rows[~first], columns)
            near = any(within.any() for _, within in within_tiles(one, other, eps))
            return rows[["_rep", "_node"]].iloc[:int(near)]

        closed = sides[0].union(sides[1]).groupBy("_rep", "_node").applyInPandas(
            close, f"_rep {kind}, _node {kind}"
        )
        return joined.select(
            F.col("vertex").alias("_rep"), F.col("component").alias("_node")
        ).union(closed)


def _values(rows: pd.DataFrame, columns: list[str]) -> np.ndarray:
    return rows[columns].to_numpy(dtype=float)


def _sorted_by(rows: pd.DataFrame, name: str) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
    """Rows in the order of a column, its distinct values, and where each of them begins."""
    values = _reps(rows, name)
    order = np.argsort(values, kind="stable")
    known, first = np.unique(values[order], return_index=True)
    return rows.iloc[order], known, first


def _reps(rows: pd.DataFrame, name: str = "_rep") -> np.ndarray:
    column = rows[name]
    return column.to_numpy(dtype="int64" if column.dtype.kind in "iuf" else object)


def neighbor_counts(
    points: DataFrame,
    columns: Sequence[str],
    eps: float = DBSCAN_EPS,
    min_samples: int = DBSCAN_MIN_SAMPLES,
    id_col: str = "CustomerID",
    block_points: int = BLOCK_POINTS,
) -> DataFrame:
    """Every row's number of rows within ``eps``, itself included, and whether it is core."""
    merged = merged_points(points, columns, id_col)
    density = _Density(merged, columns, eps, min_samples, points.schema[id_col].dataType, block_points)
    counted = materialize(density.counts(density.points), "neighbors")
    flagged = merged.join(counted, "_rep").drop("_rep", "_weight")
    return points.select(id_col, *columns).join(flagged, list(columns)).select(
        id_col, "neighbors", (F.col("neighbors") >= min_samples).alias("is_core")
    )


def dbscan(
    points: DataFrame,
    columns: Sequence[str],
    eps: float = DBSCAN_EPS,
    min_samples: int = DBSCAN_MIN_SAMPLES,
    id_col: str = "CustomerID",
    block_points: int = BLOCK_POINTS,
) -> DataFrame:
    """(id, cluster) with clusters from 0, the largest first, and -1 for noise.

    A border point that several clusters reach goes to the one with the least core point.
    """
    merged = merged_points(points, columns, id_col)
    density = _Density(merged, columns, eps, min_samples, points.schema[id_col].dataType, block_points)
    counted = density.counts(density.points.where(F.col("_group").isNull()))
    flagged = materialize(
        density.points.join(counted, "_rep", "left").withColumn(
            "is_core",
            F.col("_group").isNotNull() | F.coalesce(F.col("neighbors") >= min_samples, F.lit(False)),
        ).drop("neighbors"), "flagged",
    )
    links = materialize(density.links(flagged), "links")
    core = flagged.where("is_core").select("_rep", F.coalesce("_group", "_rep").alias("_node"))
    between = links.join(flagged.where("is_core").select("_rep"), "_rep", "left_semi")
    edges = density.group_links(between.select("_rep", "_node"))
    parts = connected_components(edges, "_rep", "_node").withColumnRenamed("vertex", "_node")
    # The least core point names a component; a group is named by its least one.
    named = materialize(
        core.join(parts, "_node", "left").select(
            "_rep", "_node", F.coalesce("component", "_node").alias("component")
        ), "core",
    )
    border = (
        links.join(core.select("_rep"), "_rep", "left_anti")
        .join(named.select("_node", "component").distinct(), "_node")
        .groupBy("_rep").agg(F.min("component").alias("component"))
    )
    labeled = merged.join(
        named.select("_rep", "component").union(border), "_rep", "left"
    ).drop("_rep", "_weight")
    rows = points.select(id_col, *columns).join(labeled, list(columns))
    return renumber(rows.select(id_col, "component"), "component", id_col, first=0)
