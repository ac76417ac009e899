"""Agglomerative clustering of weighted units, in blocks, with the tree of the whole table.

A linkage here depends only on each cluster's weight and state (mean position or label counts), so
no matrix of pairs is kept. It is reducible: merging two clusters brings neither closer to a third
than the nearer of them was. Merges of pairs that are each other's nearest may therefore happen in
any order, and units that are safe from outside may merge many times inside one block.

Each round cuts the clusters into blocks by a tree of splits and does two things.

* Search: a cluster visits every other block that could hold one as near as its nearest one in
  its own block, and finds its nearest one there. Blocks whose box is too far are not visited;
  their bound stands for them.
* Merge: a block merges pairs that are each other's nearest, again and again, as long as nothing
  outside is nearer. What lies outside may merge at the same time, which cannot bring it nearer.
  A merged cluster's distance to the outside is bounded by the linkage's update formula.

Clusters left over go to the next round, which cuts them differently, until one block is left.

Ties: a cluster is named by its greatest member, and of equally near clusters the one with the
least name counts as nearer. Pairs so ordered by (gap, greater name, lesser name) keep the property
above, hence the tree does not depend on blocks, rounds or rows on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.functions.blocks import MOST_PARTITIONS, TILE_CELLS
from clientele.storage import materialize

#: Clusters of a block; a table of more than a few hundred is cut in two at least.
BLOCK_UNITS = 2_000
LAST_UNITS = 500
SPLIT_SAMPLES = 32
#: Visitors of a block that one task compares. So few clusters may all visit every block.
MOST_VISITORS = 50_000
#: Bounds are taken down by more than their rounding.
_SLACK = 1 - 1e-9
#: Error of a squared distance from products, as a share of both norms and for each column: more
#: than its rounding.
_ROUGH = 4 * np.finfo(float).eps
#: Share of a gap within which ``_steady`` may make two of them equal, and more.
_TIED = 1e-11


def _steady(gaps: np.ndarray) -> np.ndarray:
    """Gaps rounded to 40 bits, so that equal ones are equal however they came about."""
    bits = np.ascontiguousarray(gaps).view(np.int64)
    bits += 1 << 11
    bits &= ~0xFFF
    return bits.view(np.float64)


def _centered(states: np.ndarray, middle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places measured from ``middle`` and their squared norms."""
    with np.errstate(over="ignore", invalid="ignore"):
        moved = states - middle
        return moved, np.einsum("ij,ij->i", moved, moved)


@dataclass(frozen=True)
class Ward:
    """Growth of the inner sum of squares; a state is the mean position."""

    def first(self, weight, values):
        return list(values)

    def place(self, weights, states):
        return states

    def gap(self, weights, states, other_weights, other_states):
        squares = np.zeros((len(states), len(other_states)))
        for j in range(states.shape[1]):
            apart = states[:, j, None] - other_states[None, :, j]
            apart *= apart
            squares += apart
        squares /= 1.0 / weights[:, None] + 1.0 / other_weights[None, :]
        return _steady(squares)

    def pair_gap(self, weights, states, other_weights, other_states):
        """The same of pairs, one by one, to the last bit."""
        squares = np.zeros(len(states))
        for j in range(states.shape[1]):
            apart = states[:, j] - other_states[:, j]
            apart *= apart
            squares += apart
        squares /= 1.0 / weights + 1.0 / other_weights
        return _steady(squares)

    def rough(self, other_weights, other_states, middle=None):
        """A function giving (gaps, off): gaps to these others from products, much faster than
        from differences, and how far those of each row may be off; None if they are exact."""
        if not len(other_states):
            return lambda weights, states: (np.zeros((len(states), 0)), None)
        middle = other_states.mean(axis=0) if middle is None else middle
        y, others = _centered(other_states, middle)
        if not np.isfinite(others).all():
            return lambda weights, states: (
                self.gap(weights, states, other_weights, other_states), None
            )
        y = np.ascontiguousarray(np.column_stack([-2.0 * y, np.ones(len(y)), others]).T)
        inverse, widest, top = 1.0 / other_weights, others.max(), other_weights.max()

        def gaps(weights, states):
            x, norms = _centered(states, middle)
            if not np.isfinite(norms).all():
                return self.gap(weights, states, other_weights, other_states), None
            found = np.column_stack([x, norms, np.ones(len(x))]) @ y
            found /= 1.0 / weights[:, None] + inverse
            share = _ROUGH * (len(middle) + 8)
            return found, share * (norms + widest) / (1.0 / weights + 1.0 / top)

        return gaps

    def join(self, weights, states, other_weights, other_states):
        both = weights[:, None] * states + other_weights[:, None] * other_states
        return both / (weights + other_weights)[:, None]

    def box_gap(self, weights, places, low, high, least):
        apart = np.maximum(np.maximum(low - places, places - high), 0.0)
        return (apart * apart).sum(axis=1) / (1.0 / weights + 1.0 / least)

    def outside(self, weights, outs, other_weights, other_outs, gap, least):
        total = (least + weights) * outs + (least + other_weights) * other_outs - least * gap
        return total / (least + weights + other_weights)


@dataclass(frozen=True)
class CoAssociation:
    """Mean share of runs in which members differ; a state counts the members of each label.

    Counts are whole numbers, so equal gaps are equal to the last bit.
    """

    runs: int

    def first(self, weight, values):
        return [weight * v for v in values]

    def place(self, weights, states):
        return states / weights[:, None]

    def gap(self, weights, states, other_weights, other_states):
        pairs = self.runs * weights[:, None] * other_weights[None, :]
        return (pairs - states @ other_states.T) / pairs

    def rough(self, other_weights, other_states, middle=None):
        """Counts are exact as they are."""
        return lambda weights, states: (
            self.gap(weights, states, other_weights, other_states), None
        )

    def join(self, weights, states, other_weights, other_states):
        return states + other_states

    def box_gap(self, weights, places, low, high, least):
        """Fill each run's shares, label by label from the cluster's largest, up to the box."""
        own = places.reshape(len(places), self.runs, -1)
        low = np.maximum(low, 0.0).reshape(self.runs, -1)
        high = np.minimum(high, 1.0).reshape(self.runs, -1)
        order = np.argsort(-own, axis=2, kind="stable")
        sorted_own = np.take_along_axis(own, order, axis=2)
        room = np.take_along_axis(np.broadcast_to(high - low, own.shape), order, axis=2)
        left = np.maximum(1.0 - low.sum(axis=1), 0.0)[None, :, None]
        before = np.cumsum(room, axis=2) - room
        filled = np.clip(left - before, 0.0, room)
        agree = (own * low).sum(axis=(1, 2)) + (sorted_own * filled).sum(axis=(1, 2))
        return np.maximum(1.0 - agree / self.runs, 0.0)

    def outside(self, weights, outs, other_weights, other_outs, gap, least):
        return (weights * outs + other_weights * other_outs) / (weights + other_weights)


Linkage = Ward | CoAssociation


def _tiles(rows: int, columns: int) -> Iterator[slice]:
    step = max(1, TILE_CELLS // max(columns, 1))
    return (slice(at, at + step) for at in range(0, rows, step))


def _least(gaps: np.ndarray, off: np.ndarray | None, exact) -> tuple[np.ndarray, np.ndarray]:
    """Place and value of each row's least gap, the first one on a tie.

    ``gaps`` may be ``off``; ``exact(rows, columns)`` decides among those that could be least.
    """
    here = np.arange(len(gaps))
    near = gaps.argmin(axis=1) if gaps.size else np.zeros(len(gaps), dtype=np.int64)
    found = gaps[here, near] if gaps.size else np.full(len(gaps), np.inf)
    if off is None:
        return near, found
    some = np.flatnonzero(found < np.inf)
    bar = found + 2 * off + _TIED * (np.abs(found) + off)
    could = gaps <= bar[:, None]
    # Most rows have one candidate, and then there is nothing to choose.
    several = some[:0]
    if np.count_nonzero(could) > len(some):
        several = some[np.count_nonzero(could[some], axis=1) > 1]
    found[some] = exact(some, near[some])
    if len(several):
        row, column = np.nonzero(could[several])
        values = exact(several[row], column)
        begin = np.searchsorted(row, np.arange(len(several)))
        found[several] = np.minimum.reduceat(values, begin)
        hits = np.flatnonzero(values == found[several][row])
        near[several] = column[hits[np.unique(row[hits], return_index=True)[1]]]
    return near, found


def nearest_units(weights, states, other_weights, other_states, linkage: Linkage):
    """(place, gap) of each one's nearest other, the first one on a tie; there is one at least."""
    at, out = np.zeros(len(weights), dtype=np.int64), np.empty(len(weights))
    rough = linkage.rough(other_weights, other_states)
    for part in _tiles(len(weights), len(other_weights)):
        own, places = weights[part], states[part]
        gaps, off = rough(own, places)

        def exact(rows, columns, own=own, places=places):
            return linkage.pair_gap(
                own[rows], places[rows], other_weights[columns], other_states[columns]
            )

        at[part], out[part] = _least(gaps, off, exact)
    return at, out


def merge_block(
    weights: np.ndarray, states: np.ndarray, linkage: Linkage,
    outs: np.ndarray | None = None, out_names: np.ndarray | None = None, least: float = 1.0,
):
    """Merge what is safe: (alive, weights, states, reach, merges) of clusters sorted by name.

    ``outs`` bounds each one's gap to the outside; of outside clusters at that very gap none
    comes, in the order of names, before place ``out_names`` of the block. ``merges`` has
    (lesser, greater, gap) by place, in an order in which children come first.
    """
    n = len(weights)
    weights, states = weights.astype(float).copy(), states.astype(float).copy()
    outs = np.full(n, np.inf) if outs is None else outs.astype(float).copy()
    out_names = np.zeros(n, dtype=np.int64) if out_names is None else out_names.copy()
    alive = np.ones(n, dtype=bool)
    merges: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    # The gaps that are held come from products; those that decide are taken anew, exactly.
    gaps, off = np.empty((n, n)), None
    near, reach = np.zeros(n, dtype=np.int64), np.empty(n)

    def nearest(rows: np.ndarray) -> None:
        def exact(some, columns):
            own = rows[some]
            return linkage.pair_gap(weights[own], states[own], weights[columns], states[columns])

        for part in _tiles(len(rows), n):
            own = rows[part]
            near[own], reach[own] = _least(
                gaps[own], None if off is None else off[own],
                lambda some, columns, at=part.start: exact(some + at, columns),
            )

    middle = states.mean(axis=0) if n else None
    rough = linkage.rough(weights, states, middle)
    for rows in _tiles(n, n):
        gaps[rows], own = rough(weights[rows], states[rows])
        if own is not None:
            off = np.zeros(n) if off is None else off
            off[rows] = own
    # Means of members lie no farther out than these.
    widest = _ROUGH * (states.shape[1] + 8) * 2 * _centered(states, middle)[1].max() if n else 0.0
    np.fill_diagonal(gaps, np.inf)
    nearest(np.arange(n))
    while True:
        safe = (reach < outs) | ((reach == outs) & (near < out_names))
        ok = alive & safe & (reach < np.inf)
        one = np.flatnonzero(ok & ok[near] & (near[near] == np.arange(n)) & (np.arange(n) < near))
        if not len(one):
            return alive, weights, states, reach, merges
        two = near[one]
        heights = reach[one]
        merges.append((one, two, heights))
        bound = linkage.outside(weights[one], outs[one], weights[two], outs[two], heights, least)
        bound = np.where(np.isfinite(bound), bound * _SLACK, np.inf)
        lower = np.minimum(outs[one], outs[two])
        first = np.where(
            outs[one] < outs[two], out_names[one],
            np.where(outs[one] > outs[two], out_names[two], np.minimum(out_names[one], out_names[two])),
        )
        outs[two] = np.maximum(bound, lower)
        out_names[two] = np.where(bound > lower, 0, first)
        states[two] = linkage.join(weights[one], states[one], weights[two], states[two])
        weights[two] += weights[one]
        alive[one] = False
        gaps[one, :] = gaps[:, one] = np.inf
        kept = np.flatnonzero(alive)
        fresh, _ = linkage.rough(weights[kept], states[kept], middle)(weights[two], states[two])
        if off is not None:
            # Weights have grown, and gaps to heavier clusters may be off by more.
            off = widest / (1.0 / weights + 1.0 / weights[kept].max())
        gaps[np.ix_(two, kept)] = fresh
        gaps[np.ix_(kept, two)] = fresh.T
        gaps[two, two] = np.inf
        touched = np.zeros(n, dtype=bool)
        touched[one] = touched[two] = True
        nearest(np.flatnonzero(alive & (touched | touched[near])))


@dataclass
class Splits:
    """A binary tree of splits: nodes with boxes, leaves numbered as blocks."""

    column: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    children: list[tuple[int, int]] = field(default_factory=list)
    block: list[int] = field(default_factory=list)
    low: list[np.ndarray] = field(default_factory=list)
    high: list[np.ndarray] = field(default_factory=list)
    blocks: int = 0

    def grow(self, sample: np.ndarray, blocks: int, low, high, rng) -> int:
        """Halve the blocks, and the sample as they are, by one of the columns with the widest spread."""
        node = len(self.column)
        for name, empty in (("column", -1), ("value", 0.0), ("children", (-1, -1)), ("block", -1)):
            getattr(self, name).append(empty)
        self.low.append(low)
        self.high.append(high)
        spread = sample.std(axis=0) if len(sample) else np.zeros(len(low))
        wide = [c for c in np.argsort(-spread, kind="stable")[:3] if spread[c] > 0]
        if blocks < 2 or not wide:
            self.block[node] = self.blocks
            self.blocks += 1
            return node
        column = int(rng.choice(wide))
        values = np.sort(sample[:, column])
        half = blocks // 2
        # The last value of the lower part; not the greatest one, so that both sides hold some.
        value = float(values[max(len(values) * half // blocks - 1, 0)])
        if value == values[-1]:
            value = float(values[np.searchsorted(values, value) - 1])
        under = sample[:, column] <= value
        below, above = high.copy(), low.copy()
        below[column] = above[column] = value
        left = self.grow(sample[under], half, low, below, rng)
        right = self.grow(sample[~under], blocks - half, above, high, rng)
        self.column[node], self.value[node], self.children[node] = column, value, (left, right)
        return node

    def locate(self, places: np.ndarray) -> np.ndarray:
        found = np.empty(len(places), dtype=np.int64)
        stack = [(0, np.arange(len(places)))]
        while stack:
            node, rows = stack.pop()
            if self.block[node] >= 0:
                found[rows] = self.block[node]
                continue
            under = places[rows, self.column[node]] <= self.value[node]
            left, right = self.children[node]
            stack += [(left, rows[under]), (right, rows[~under])]
        return found

    def visits(self, places, weights, reach, own, linkage: Linkage, least: float):
        """(rows, blocks) that each row has to visit, and the least bound of all others."""
        bound = np.full(len(places), np.inf)
        rows_out, blocks_out = [], []
        stack = [(0, np.arange(len(places)))]
        while stack:
            node, rows = stack.pop()
            if not len(rows):
                continue
            if node:
                gap = _SLACK * linkage.box_gap(
                    weights[rows], places[rows], self.low[node], self.high[node], least
                )
                far = gap > reach[rows]
                bound[rows[far]] = np.minimum(bound[rows[far]], gap[far])
                rows = rows[~far]
            if self.block[node] >= 0:
                rows = rows[own[rows] != self.block[node]]
                rows_out.append(rows)
                blocks_out.append(np.full(len(rows), self.block[node]))
            else:
                stack += [(child, rows) for child in self.children[node]]
        return np.concatenate(rows_out), np.concatenate(blocks_out), bound


def _names(column) -> np.ndarray:
    return column.to_numpy(dtype=object)


def _arrays(rows: pd.DataFrame, columns: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    return rows["weight"].to_numpy(dtype=float), rows[list(columns)].to_numpy(dtype=float)


@dataclass
class _Placing:
    """What a task needs to put clusters into blocks; ``sent`` is the broadcast tree."""

    sent: object
    columns: list[str]
    linkage: Linkage
    least: float = 1.0

    def places(self, rows: pd.DataFrame):
        weights, states = _arrays(rows, self.columns)
        return weights, self.linkage.place(weights, states)

    def own(self, rows: pd.DataFrame) -> np.ndarray:
        return self.sent.value.locate(self.places(rows)[1])

    def visits(self, rows: pd.DataFrame):
        """(own block of each row, visiting rows, visited blocks, bound of all others)."""
        weights, places = self.places(rows)
        own = self.sent.value.locate(places)
        reach = rows["reach"].to_numpy(dtype=float)
        return own, *self.sent.value.visits(
            places, weights, reach, own, self.linkage, self.least
        )


class _Round:
    """One round over the stored clusters (unit, weight, reach, *columns)."""

    def __init__(self, current: DataFrame, units: int, blocks: int, number: int,
                 columns: Sequence[str], linkage: Linkage):
        self.current, self.number, self.linkage = current, number, linkage
        self.units = units
        self.cores = current.sparkSession.sparkContext.defaultParallelism
        self.columns = list(columns)
        tree = Splits()
        sample = np.zeros((0, len(self.columns)))
        if blocks > 1:
            share = min(1.0, blocks * SPLIT_SAMPLES / units)
            drawn = F.pmod(F.xxhash64("unit", F.lit(number)), F.lit(1 << 30)) < share * (1 << 30)
            rows = current.where(drawn).select("unit", "weight", *self.columns).toPandas()
            sample = linkage.place(*_arrays(rows.sort_values("unit"), self.columns))
        wide = np.full(len(self.columns), np.inf)
        tree.grow(sample, blocks, -wide, wide, np.random.default_rng(number))
        self.blocks = tree.blocks
        #: Nothing is known yet of how near others are, and the clusters are too many to ask all.
        self.opening = number == 0 and self.blocks > 1 and units > MOST_VISITORS
        self.placing = _Placing(
            current.sparkSession.sparkContext.broadcast(tree), self.columns, linkage
        )
        self.fields = "unit string, weight double, reach double, " + ", ".join(
            f"`{c}` double" for c in self.columns
        )

    def visitors(self) -> DataFrame:
        """Each cluster once for each block it visits, with its own block as ``home``."""
        placing = self.placing

        def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for rows in filter(len, batches):
                own, who, where, _ = placing.visits(rows)
                yield rows.iloc[who].assign(
                    unit=_names(rows["unit"])[who], home=own[who], block=where
                )

        return self.current.mapInPandas(visit, self.fields + ", home bigint, block bigint")

    def search(self) -> DataFrame:
        """(block, unit, out, out_unit): nearest clusters of visited blocks, by home block."""
        columns, linkage, placing = self.columns, self.linkage, self.placing
        # Few blocks are cut so that every core has a part.
        least = max(1, -(-self.cores // self.blocks))
        parts = F.lit(least)
        if self.units > MOST_VISITORS:
            counts = {
                r.block: -(-r["count"] // MOST_VISITORS)
                for r in self.visitors().select("block").groupBy("block").count().collect()
            }
            crowded = {b: n for b, n in counts.items() if n > least}
            if crowded:
                table = F.create_map(*[
                    F.lit(x).cast(t) for pair in crowded.items() for x, t in zip(pair, ("long", "int"))
                ])
                parts = F.coalesce(table[F.col("block")], parts)

        def at_home(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for rows in filter(len, batches):
                yield rows.assign(home=-1, block=placing.own(rows))

        homes = self.current.mapInPandas(at_home, self.fields + ", home bigint, block bigint")
        homes = homes.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
        guests = self.visitors().withColumn("part", F.pmod(F.xxhash64("unit"), parts).cast("int"))

        def nearest(rows: pd.DataFrame) -> pd.DataFrame:
            here = rows[rows["home"] < 0].sort_values("unit")
            guests = rows[rows["home"] >= 0]
            if not len(here):
                guests = guests.iloc[:0]
            at, out = nearest_units(*_arrays(guests, columns), *_arrays(here, columns), linkage)
            return pd.DataFrame({
                "block": guests["home"].to_numpy(), "unit": _names(guests["unit"]),
                "out": out, "out_unit": _names(here["unit"])[at],
            })

        # The rows are few and the work is not: partitions of their own number are not merged.
        met = homes.unionByName(guests).repartition(
            min(2 * least * self.blocks, MOST_PARTITIONS), "block", "part"
        )
        return met.groupBy("block", "part").applyInPandas(
            nearest, "block bigint, unit string, out double, out_unit string"
        )

    def merge(self) -> DataFrame:
        """Clusters that are left (reach set) and merges (near set), stored.

        Without any reach yet, nothing is known of the outside, and only the reach is found.
        """
        columns, linkage, placing = self.columns, self.linkage, self.placing
        opening = self.opening

        def at_home(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for rows in filter(len, batches):
                if opening:
                    yield rows.assign(block=placing.own(rows), out=-1.0, out_unit="")
                else:
                    own, _, _, bound = placing.visits(rows)
                    yield rows.assign(block=own, out=bound, out_unit="")

        fields = self.fields + ", block bigint, out double, out_unit string"
        rows = self.current.mapInPandas(at_home, fields)
        if self.blocks > 1 and not opening:
            rows = rows.unionByName(self.search(), allowMissingColumns=True)

        def work(rows: pd.DataFrame) -> pd.DataFrame:
            best = rows.sort_values(["unit", "out", "out_unit"]).drop_duplicates("unit")
            here = rows[rows["weight"].notna()].sort_values("unit")
            names = _names(here["unit"])
            outs = best["out"].to_numpy(dtype=float)
            places = np.searchsorted(names, _names(best["out_unit"]))
            alive, weights, states, reach, merges = merge_block(
                *_arrays(here, columns), linkage, outs, places, placing.least
            )
            block = int(here["block"].iloc[0])
            one, two, gap = (np.concatenate(m) for m in zip(*merges)) if merges else ([], [], [])
            left, done = int(alive.sum()), len(one)
            none = np.full(done, np.nan)
            return pd.DataFrame({
                "unit": np.concatenate([names[alive], names[one]]) if done else names[alive],
                "weight": np.concatenate([weights[alive], none]),
                "reach": np.concatenate([reach[alive], none]),
                **{c: np.concatenate([v, none]) for c, v in zip(columns, states[alive].T)},
                "near": [None] * left + list(names[two] if done else []),
                "gap": np.concatenate([np.full(left, np.nan), gap]),
                "block": block,
            })

        schema = self.fields + ", near string, gap double, block bigint"
        rows = rows.repartition(min(2 * self.blocks, MOST_PARTITIONS), "block")
        return materialize(rows.groupBy("block").applyInPandas(work, schema), "merged")


def merges_of(
    units: DataFrame, columns: Sequence[str], linkage: Linkage, block_units: int = BLOCK_UNITS
) -> DataFrame:
    """(unit, near, gap, round, block): ``near`` takes ``unit`` over, for every cluster but one.

    ``units`` has (unit, weight, *columns), no two with the same values.
    """
    columns = list(columns)
    values = linkage.first(F.col("weight"), [F.col(c) for c in columns])
    current = materialize(units.select(
        F.col("unit").cast("string").alias("unit"), F.col("weight").cast("double").alias("weight"),
        F.lit(float("inf")).alias("reach"),
        *[v.cast("double").alias(c) for v, c in zip(values, columns)],
    ), "units")
    done, number, size = [], 0, block_units
    left = current.count()
    while left > 1:
        blocks = max(-(-left // size), min(2, -(-left // LAST_UNITS)))
        step = _Round(current, left, blocks, number, columns, linkage).merge()
        merges = step.where(F.col("near").isNotNull())
        current = step.where(F.col("near").isNull()).select("unit", "weight", "reach", *columns)
        now = current.count()
        if now < left:
            done.append(merges.select("unit", "near", "gap", F.lit(number).alias("round"), "block"))
            size = block_units
        elif number:
            # Nothing was safe in any block: the next ones are larger.
            size = max(2 * size, LAST_UNITS)
        left, number = now, number + 1
    if not done:
        return units.sparkSession.createDataFrame(
            [], "unit string, near string, gap double, round int, block bigint"
        )
    every = done[0]
    for merges in done[1:]:
        every = every.union(merges)
    return every


def cut(merges: DataFrame, k: int) -> DataFrame:
    """``merges`` without the k - 1 last ones of the tree."""
    order = [F.col("gap"), F.col("near"), F.col("unit")]
    dropped = merges.orderBy(*[c.desc() for c in order]).limit(max(k - 1, 0)).collect()
    if not dropped:
        return merges
    last = dropped[-1]
    gap = F.lit(last.gap)
    return merges.where(
        (F.col("gap") < gap) | ((F.col("gap") == gap) & (
            (F.col("near") < last.near)
            | ((F.col("near") == last.near) & (F.col("unit") < last.unit))
        ))
    )


def _followed(rows: pd.DataFrame) -> pd.DataFrame:
    """Each taken-over cluster of a block with the last one that took it over there."""
    one, two = _names(rows["unit"]), _names(rows["near"])
    names, at = np.unique(np.concatenate([one, two]), return_inverse=True)
    to = np.arange(len(names))
    to[at[:len(one)]] = at[len(one):]
    while (to[to] != to).any():
        to = to[to]
    return pd.DataFrame({
        "round": rows["round"].to_numpy(), "unit": one, "root": names[to[at[:len(one)]]],
    })


def agglomerate_table(
    units: DataFrame, columns: Sequence[str], k: int, linkage: Linkage,
    block_units: int = BLOCK_UNITS,
) -> DataFrame:
    """(unit, label) for a table (unit, weight, *columns); labels are names of units."""
    merges = merges_of(units, columns, linkage, block_units)
    moves = materialize(
        cut(merges, k).groupBy("round", "block").applyInPandas(
            _followed, "round int, unit string, root string"
        ), "moves",
    )
    labels = units.select("unit", F.col("unit").cast("string").alias("label"))
    for number in sorted(r["round"] for r in moves.select("round").distinct().collect()):
        step = moves.where(F.col("round") == number).select(F.col("unit").alias("label"), "root")
        labels = labels.join(step, "label", "left").select(
            "unit", F.coalesce("root", "label").alias("label")
        )
    return labels
