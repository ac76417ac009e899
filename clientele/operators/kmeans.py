"""K-means for many models at once.

Choosing k, the gap statistic and consensus clustering all need dozens of fits of the same rows:
several k, several starts, several seeds. Fitting them one after another would scan the table
once per model and iteration. Here one scan per iteration serves every model: the rows meet all
centres in matrix products, in tiles that fit a core's cache, and a partition passes on one row of
sums per model and cluster, which Spark adds up. Centres (models x k x columns) are all that
reaches the driver.

Starts of one model that come to the same centres on the pool count once. All starts run a few
passes, or until their centres move no more than the tolerance, and the best of each model runs on
until its centres do not move at all, which is when no row changes its cluster any more. Those
last iterations are many and small, so a scan serves several of them: rows whose second nearest
centre is farther than the nearest one by more than twice a radius keep their cluster while no
centre leaves that radius (the bound of Hamerly, 2010). They come back as sums, the few others as
rows, and the iteration goes on with both as long as the radius holds.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.constants import SEED, STARTS

#: Candidates of a pool: a uniform draw first, then expected draws in each round.
FIRST_DRAW = 256
DRAWS = 1_024
ROUNDS = 4
MAX_PASSES = 300
POOL_PASSES = 50
#: Passes of all starts, and further ones of the best on each uniform set.
START_PASSES = 8
UNIFORM_PASSES = 12
#: Rows of a model that may come back as rows.
LOOSE_ROWS = 2_000
TOLERANCE = 1e-4
#: Share of the variance below which centres stand still but for rounding.
STILL = 1e-18
#: Squared distances computed at a time, and rows of such a tile at least.
TILE_CELLS = 1 << 18
TILE_ROWS = 16


@dataclass
class Model:
    """One fit: which set of rows it belongs to, its centres and how well they fit."""

    centers: np.ndarray
    part: int = 0
    #: Starts of one wanted model share its number.
    wanted: int = 0
    cost: float = float("inf")
    #: Squared movement of the centres in the last pass.
    step: float = 0.0
    settled: bool = False
    passes: int = 0


#: Rows of a partition, at most about so many.
PARTITION_ROWS = 100_000


def spread(points: DataFrame, key: str = "CustomerID") -> DataFrame:
    """Partitions by the number of rows, and one per core at least: the passes are bound by
    arithmetic, not by reading."""
    cores = points.sparkSession.sparkContext.defaultParallelism
    return points.repartition(max(cores, -(-points.count() // PARTITION_ROWS)), key)


#: Candidate rows and how many rows of the table each one is the nearest of.
Pool = tuple[np.ndarray, np.ndarray]


def seed_pools(
    points: DataFrame, columns: Sequence[str], seeds: Sequence[int], id_col: str = "CustomerID"
) -> list[Pool]:
    """Candidates for starting centres for each seed, drawn from all rows in a few passes.

    The rounds of k-means|| (Bahmani et al., 2012): after a small uniform draw, each round takes
    rows in proportion to their squared distance from the candidates so far, so rare far groups
    are found whatever the size of the table. A round draws and sums the distances in one scan:
    its chances are taken against the sum of the round before, which is no smaller, so it draws
    ``DRAWS`` rows at most in the mean. A last pass counts the rows of each candidate. Draws are
    hashes of the id, so they do not depend on the layout. One pass serves all seeds.
    """
    columns, places = list(columns), range(len(seeds))
    stats = points.agg(
        F.count("*").alias("rows"),
        sum((F.var_pop(c) for c in columns), F.lit(0.0)).alias("spread"),
        F.first(F.struct(*columns)).alias("one"),
    ).first()
    if not stats.rows:
        return [(np.zeros((0, len(columns))), np.zeros(0)) for _ in seeds]
    even = [f"_draw{i}" for i in places]
    schema = "pool int, cost double, " + ", ".join(f"`{c}` double" for c in columns)
    context = points.sparkSession.sparkContext

    def draw(round_: int, sent, wanted: list[float]) -> tuple[list[np.ndarray], np.ndarray]:
        """Each pool's rows whose draw falls below their chance, and its sum of distances."""
        def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            costs = np.zeros(len(wanted))
            for batch in batches:
                data = batch[columns].to_numpy(dtype=float)
                for i in places:
                    gap = _nearest(data, sent.value[i])[1] if sent else np.ones(len(data))
                    costs[i] += gap.sum()
                    taken = batch[columns][batch[even[i]].to_numpy() < gap * wanted[i]]
                    yield taken.assign(pool=i, cost=np.nan)[["pool", "cost", *columns]]
            yield pd.DataFrame({"pool": list(places), "cost": costs}).reindex(
                columns=["pool", "cost", *columns]
            )

        ids = F.col(id_col).cast("string")
        draws = [
            (F.pmod(F.xxhash64(F.lit(seed), F.lit(round_), ids), F.lit(1 << 30)) / float(1 << 30))
            .alias(name) for name, seed in zip(even, seeds)
        ]
        found = points.select(*columns, *draws).mapInPandas(pick, schema).toPandas()
        sums = found["cost"].notna()
        costs = found[sums].groupby("pool")["cost"].sum().reindex(places, fill_value=0.0)
        rows = found[~sums]
        return (
            [rows[rows["pool"] == i][columns].to_numpy(dtype=float) for i in places],
            costs.to_numpy(),
        )

    drawn, _ = draw(-1, None, [FIRST_DRAW / stats.rows] * len(seeds))
    one = np.array([stats.one], dtype=float)
    pools = [np.unique(d if len(d) else one, axis=0) for d in drawn]
    total = np.full(len(seeds), stats.rows * stats.spread)
    for round_ in range(ROUNDS):
        if not total.any():
            break
        sent = context.broadcast(pools)
        wanted = [DRAWS / t if t > 0 else 0.0 for t in total]
        drawn, total = draw(round_, sent, wanted)
        sent.destroy()
        pools = [np.unique(np.vstack([p, d]), axis=0) for p, d in zip(pools, drawn)]

    sent = context.broadcast(pools)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = [np.zeros(len(pool)) for pool in sent.value]
        for batch in batches:
            data = batch[columns].to_numpy(dtype=float)
            for i in places:
                found[i] += np.bincount(_nearest(data, sent.value[i])[0], minlength=len(found[i]))
        for i in places:
            some = np.flatnonzero(found[i])
            yield pd.DataFrame({"pool": i, "candidate": some, "n": found[i][some]})

    table = points.select(*columns).mapInPandas(
        count, "pool int, candidate long, n double"
    ).groupBy("pool", "candidate").agg(F.sum("n").alias("n")).toPandas()
    sent.destroy()
    weights = [np.zeros(len(p)) for p in pools]
    for i, own in table.groupby("pool"):
        weights[i][own["candidate"].to_numpy()] = own["n"].to_numpy()
    return list(zip(pools, weights))


def _extended(data: np.ndarray) -> np.ndarray:
    """(x, |x|^2, 1) of each row, whose products with the next are squared distances."""
    return np.column_stack([data, np.einsum("ij,ij->i", data, data), np.ones(len(data))])


def _extended_centers(centers: np.ndarray) -> np.ndarray:
    """(-2c, 1, |c|^2) of each centre."""
    return np.column_stack([
        -2.0 * centers, np.ones(len(centers)), np.einsum("ij,ij->i", centers, centers)
    ])


def _tile_rows(centers: int) -> int:
    return max(TILE_ROWS, TILE_CELLS // max(centers, 1))


def _nearest(data: np.ndarray, pool: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest candidate of each row and the squared distance, in parts of bounded size."""
    label, gap = np.empty(len(data), dtype=np.int64), np.empty(len(data))
    rows, others = _extended(data), _extended_centers(pool).T
    step = _tile_rows(len(pool))
    for at in range(0, len(data), step):
        gaps = rows[at:at + step] @ others
        found = gaps.argmin(axis=1)
        label[at:at + step] = found
        gap[at:at + step] = gaps[np.arange(len(gaps)), found]
    return label, np.maximum(gap, 0.0)


def spread_out_centers(
    rows: np.ndarray, weights: np.ndarray, k: int, rng: np.random.Generator
) -> np.ndarray:
    """k-means++ (Arthur and Vassilvitskii, 2007), the best of a few candidates at each step."""
    tries = 2 + int(np.log(k))
    centers = [rows[rng.choice(len(rows), p=weights / weights.sum())]]
    nearest = ((rows - centers[0]) ** 2).sum(axis=1)
    while len(centers) < k:
        chances = (nearest * weights).cumsum()
        picks = np.searchsorted(chances, rng.random(tries) * chances[-1])
        picks = np.minimum(picks, len(rows) - 1)
        gaps = ((rows[picks][:, None, :] - rows[None, :, :]) ** 2).sum(axis=2)
        lowered = np.minimum(gaps, nearest)
        best = (lowered * weights).sum(axis=1).argmin()
        centers.append(rows[picks[best]])
        nearest = lowered[best]
    return np.array(centers)


def nearest_centers(
    data: np.ndarray, centers: np.ndarray, groups: list[slice], second: bool = False
):
    """For each group of centres the nearest one and the squared distance to it.

    With ``second`` also the squared distance to the second nearest one.
    """
    found = [
        (np.empty(len(data), dtype=np.int64), *(np.empty(len(data)) for _ in range(1 + second)))
        for _ in groups
    ]
    for part, gaps, _ in _tiles(data, centers):
        here = np.arange(gaps.shape[1])
        for group, (label, nearest, *other) in zip(groups, found):
            block = gaps[group]
            own = block.argmin(axis=0)
            label[part] = own
            nearest[part] = np.maximum(block[own, here], 0.0)
            if second:
                block[own, here] = np.inf
                other[0][part] = np.maximum(block.min(axis=0), 0.0)
    return found


def _tiles(data: np.ndarray, centers: np.ndarray):
    """Squared distances of all centres to a few rows at a time: (rows, distances, (x, |x|^2, 1)).

    The distances lie in a buffer that the next tile uses again.
    """
    rows, others = _extended(data), _extended_centers(centers)
    step = _tile_rows(len(centers))
    space = np.empty(len(centers) * min(step, len(data)))
    for at in range(0, len(data), step):
        own = rows[at:at + step]
        gaps = space[:len(centers) * len(own)].reshape(len(centers), len(own))
        yield slice(at, at + len(own)), np.matmul(others, own.T, out=gaps), own


def cluster_sums(data: np.ndarray, centers: np.ndarray, groups: list[slice]) -> np.ndarray:
    """Rows, cost and column sums (n, cost, s...) of each centre's rows within its group."""
    width = data.shape[1]
    sums, costs = np.zeros((len(centers), width + 2)), np.zeros(len(centers))
    space = np.empty(len(centers) * min(_tile_rows(len(centers)), len(data)))
    for _, gaps, rows in _tiles(data, centers):
        held = space[:gaps.size].reshape(gaps.shape)
        for group in groups:
            block, own = gaps[group], held[group]
            nearest = block.min(axis=0)
            np.equal(block, nearest, out=own, casting="unsafe")
            if own.sum() != len(rows):
                # Several centres at one distance, or none: the first one has the row.
                own[:] = block.argmin(axis=0) == np.arange(len(block))[:, None]
            costs[group] += own @ np.maximum(nearest, 0.0)
        sums += held @ rows
    return np.column_stack([sums[:, -1], costs, sums[:, :width]])


def stacked(models: Sequence[Model]) -> tuple[np.ndarray, list[slice]]:
    ends = np.cumsum([len(m.centers) for m in models])
    groups = [slice(end - len(m.centers), end) for m, end in zip(models, ends)]
    return np.vstack([m.centers for m in models]), groups


def refined_on_pool(rows: np.ndarray, weights: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Lloyd's iteration on the weighted candidates alone."""
    k = len(centers)
    mean = np.average(rows, axis=0, weights=weights)
    limit = TOLERANCE * np.average((rows - mean) ** 2, axis=0, weights=weights).mean()
    for _ in range(POOL_PASSES):
        (label, _), = nearest_centers(rows, centers, [slice(0, k)])
        own = (label == np.arange(k)[:, None]) * weights
        sizes = own.sum(axis=1, keepdims=True)
        moved = np.where(sizes > 0, own @ rows / np.maximum(sizes, 1), centers)
        step = ((moved - centers) ** 2).sum()
        centers = moved
        if step <= limit:
            break
    return centers


def starting_models(
    spark: SparkSession, pools: dict[int, Pool], wanted: Sequence[tuple[int, int, int]],
    starts: int = STARTS,
) -> list[Model]:
    """``starts`` models for each wanted (part, k, seed), begun on the part's pool.

    One sequence of far candidates serves every k: its first k begin the model of k clusters.
    Starting points refined on a bounded pool (Bradley and Fayyad, 1998) save most of the passes
    over the whole table, and starts that end at the same points there are one model. The
    sequences are independent and run as tasks of their own.
    """
    sizes: dict[tuple[int, int], dict[int, int]] = {}
    for i, (part, k, seed) in enumerate(wanted):
        if len(pools[part][0]) < k:
            raise ValueError(f"{len(pools[part][0])} distinct rows cannot form {k} clusters")
        sizes.setdefault((part, seed), {})[i] = k
    sent = spark.sparkContext.broadcast((pools, sizes))
    width = next(iter(pools.values()))[0].shape[1]

    def begin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                rows, weights = sent.value[0][r.part]
                models = sent.value[1][r.part, r.seed]
                rng = np.random.default_rng([r.seed, r.start])
                far = spread_out_centers(rows, weights, max(models.values()), rng)
                for i, k in models.items():
                    centers = refined_on_pool(rows, weights, far[:k])
                    out = pd.DataFrame(centers, columns=[f"c{j}" for j in range(width)])
                    out.insert(0, "model", i)
                    out.insert(1, "start", r.start)
                    out.insert(2, "cluster", np.arange(k))
                    yield out

    tasks = spark.createDataFrame(
        [(*key, start) for key in sizes for start in range(starts)],
        "part int, seed long, start int",
    )
    cores = spark.sparkContext.defaultParallelism
    tasks = tasks.repartition(min(len(sizes) * starts, cores), "part", "seed", "start")
    schema = "model int, start int, cluster int, " + ", ".join(f"c{j} double" for j in range(width))
    centers = tasks.mapInPandas(begin, schema).toPandas()
    sent.destroy()
    models, seen = [], set()
    for (i, _), c in centers.sort_values(["model", "start", "cluster"]).groupby(["model", "start"]):
        found = c.iloc[:, 3:].to_numpy()
        key = i, np.unique(np.round(found, 9), axis=0).tobytes()
        if key not in seen:
            seen.add(key)
            models.append(Model(found, wanted[i][0], int(i)))
    return models


#: A table and what turns its batches into pairs (part, rows as an array).
Source = tuple[DataFrame, Callable[[pd.DataFrame], Iterator[tuple[int, np.ndarray]]]]


def table_source(points: DataFrame, columns: Sequence[str], part: int = 0) -> Source:
    columns = list(columns)

    def read(batch: pd.DataFrame) -> Iterator[tuple[int, np.ndarray]]:
        yield part, batch[columns].to_numpy(dtype=float)

    return points.select(*columns), read


def one_pass(sources: Sequence[Source], models: dict[int, Model]) -> pd.DataFrame:
    """Rows, cost and column sums of each cluster of each model."""
    plan = {}
    for part in {m.part for m in models.values()}:
        own = {i: m for i, m in models.items() if m.part == part}
        plan[part] = (list(own), *stacked(list(own.values())))
    width = next(iter(models.values())).centers.shape[1]
    sums = [f"s{j}" for j in range(width)]
    names = ["n", "cost", *sums]
    sent = sources[0][0].sparkSession.sparkContext.broadcast(plan)

    def add_up(read):
        def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held: dict[int, np.ndarray] = {}
            for batch in batches:
                for part, rows in read(batch):
                    if part not in sent.value or not len(rows):
                        continue
                    ids, centers, groups = sent.value[part]
                    totals = cluster_sums(rows, centers, groups)
                    for i, group in zip(ids, groups):
                        held[i] = held[i] + totals[group] if i in held else totals[group]
            for i, totals in held.items():
                out = pd.DataFrame(totals, columns=names)
                out.insert(0, "model", i)
                out.insert(1, "cluster", np.arange(len(totals)))
                yield out

        return work

    schema = "model long, cluster long, " + ", ".join(f"{n} double" for n in names)
    added = [table.mapInPandas(add_up(read), schema) for table, read in sources]
    totals = (
        reduce(DataFrame.union, added).groupBy("model", "cluster")
        .agg(*[F.sum(n).alias(n) for n in names]).toPandas()
    )
    sent.destroy()
    return totals


def fit_models(
    points: DataFrame,
    columns: Sequence[str],
    models: Sequence[Model],
    others: Sequence[Source] = (),
    spreads: dict[int, float] | None = None,
    max_passes: int = MAX_PASSES,
) -> list[Model]:
    """The best start of each wanted model, after Lloyd's iteration on all of them together.

    ``points`` are part 0; ``others`` are sources of further parts, whose variances per column
    ``spreads`` has. Part 0 ends with centres that do not move any more.
    """
    columns = list(columns)
    keep = points.select(*columns).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        own = keep.agg(sum((F.var_pop(c) for c in columns), F.lit(0.0)).alias("s")).first().s
        spreads = {0: (own or 0.0) / len(columns), **(spreads or {})}
        sources = [table_source(keep, columns), *others]
        limits = {p: TOLERANCE * v for p, v in spreads.items()}
        _lloyd(sources, models, limits, START_PASSES)
        best: dict[int, Model] = {}
        for model in models:
            if model.wanted not in best or model.cost < best[model.wanted].cost:
                best[model.wanted] = model
        for model in best.values():
            model.settled = False
        _lloyd(sources, [m for m in best.values() if m.part], limits, UNIFORM_PASSES)
        _to_the_end(keep, columns, [m for m in best.values() if not m.part],
                    STILL * spreads[0], max_passes)
        return [best[i] for i in sorted(best)]
    finally:
        keep.unpersist()


def _loose_pass(points: DataFrame, columns: list[str], models: dict[int, Model], radii):
    """Sums (kind, model, cluster, n, cost, s...) of the rows at these centres.

    Kind 0 are rows that cannot change their cluster within the radius, kind 1 the others, which
    also come one by one as kind 2, unless a partition has too many of them: kind 3.
    """
    centers, groups = stacked(list(models.values()))
    spark = points.sparkSession
    sent = spark.sparkContext.broadcast((list(models), centers, groups, radii))
    cap = 16 + 2 * LOOSE_ROWS // points.rdd.getNumPartitions()
    names = ["n", "cost", *[f"s{j}" for j in range(len(columns))]]

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, centers, groups, radii = sent.value
        held: dict[tuple[int, int], np.ndarray] = {}
        loose: dict[int, int] = dict.fromkeys(ids, 0)
        for batch in batches:
            data = batch.to_numpy(dtype=float)
            if not len(data):
                continue
            found = nearest_centers(data, centers, groups, second=True)
            for i, group, (label, gap, other) in zip(ids, groups, found):
                k = group.stop - group.start
                near = np.sqrt(other) - np.sqrt(gap) <= 2 * radii[i] * (1 + 1e-9) + 1e-12
                mine = label == np.arange(k)[:, None]
                for kind, rows in ((0, ~near), (1, near)):
                    own = (mine & rows).astype(float)
                    sums = np.column_stack([own.sum(axis=1), own @ gap, own @ data])
                    held[kind, i] = held.get((kind, i), 0.0) + sums
                loose[i] += int(near.sum())
                if loose[i] <= cap:
                    out = pd.DataFrame(data[near], columns=names[2:])
                    yield out.assign(kind=2, model=i, cluster=label[near], n=1.0, cost=gap[near])
        for (kind, i), sums in held.items():
            out = pd.DataFrame(sums, columns=names)
            yield out.assign(kind=kind, model=i, cluster=np.arange(len(sums)))
        for i, rows in loose.items():
            if rows > cap:
                out = pd.DataFrame(np.zeros((1, len(names))), columns=names)
                yield out.assign(kind=3, model=i, cluster=0)

    schema = "kind int, model long, cluster long, " + ", ".join(f"{n} double" for n in names)
    single = F.when(F.col("kind") == 2, F.monotonically_increasing_id())
    found = points.select(*columns).mapInPandas(add_up, schema).groupBy(
        "kind", "model", "cluster", single.alias("row")
    ).agg(*[F.sum(n).alias(n) for n in names]).toPandas()
    sent.destroy()
    return found, names


def _to_the_end(points, columns, models, still: float, max_passes: int) -> None:
    """Lloyd's iteration until no centre moves any more."""
    radii = {i: float(np.sqrt(m.step)) * 8 for i, m in enumerate(models)}
    for _ in range(max_passes):
        active = {i: m for i, m in enumerate(models) if not m.settled}
        if not active:
            return
        found, names = _loose_pass(points, columns, active, radii)
        for i, rows in found.groupby("model"):
            model, k = models[i], len(models[i].centers)
            model.passes += 1

            def summed(kind, rows=rows, k=k):
                own = rows[rows["kind"] == kind].set_index("cluster")[names]
                return own.reindex(range(k), fill_value=0.0).to_numpy()

            fixed, total = summed(0), summed(0) + summed(1)
            model.cost = float(total[:, 1].sum())
            start = model.centers
            model.centers = _means(total, start)
            if ((model.centers - start) ** 2).sum() <= still:
                model.settled = True
                continue
            if (rows["kind"] == 3).any():
                radii[i] /= 4
                continue
            loose = rows[rows["kind"] == 2][names[2:]].to_numpy()
            for _ in range(MAX_PASSES):
                away = np.sqrt(((model.centers - start) ** 2).sum(axis=1).max())
                if away > radii[i]:
                    # Centres went farther than the rows were settled for: scan from here.
                    radii[i] *= 2
                    break
                (label, _), = nearest_centers(loose, model.centers, [slice(0, k)])
                own = (label == np.arange(k)[:, None]).astype(float)
                sums = fixed.copy()
                sums[:, 0] += own.sum(axis=1)
                sums[:, 2:] += own @ loose
                moved = _means(sums, model.centers)
                step = ((moved - model.centers) ** 2).sum()
                model.centers = moved
                if step <= still:
                    break


def _means(sums: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Centres of rows (n, cost, sums...); an empty cluster keeps its own."""
    filled = sums[:, :1] > 0
    return np.where(filled, sums[:, 2:] / np.where(filled, sums[:, :1], 1.0), centers)


def _lloyd(sources, models, limits, max_passes) -> None:
    """Passes until each model's centres moved no more than its part's limit."""
    begun = {id(m): m.passes for m in models}
    while not all(m.settled for m in models):
        active = {i: m for i, m in enumerate(models) if not m.settled}
        parts = {m.part for m in active.values()}
        used = sources if parts - {0} else sources[:1]
        for i, rows in one_pass(used, active).groupby("model"):
            model = models[i]
            model.passes += 1
            model.cost = float(rows["cost"].sum())
            filled = rows[rows["n"] > 0]
            moved = model.centers.copy()
            at = filled["cluster"].to_numpy()
            moved[at] = filled.filter(regex=r"^s\d+$").to_numpy() / filled[["n"]].to_numpy()
            model.step = float(((moved - model.centers) ** 2).sum())
            model.settled = model.step <= limits[model.part] or (
                model.passes - begun[id(model)] >= max_passes
            )
            # The cost belongs to the centres that were measured.
            if not model.settled:
                model.centers = moved


def assign(
    points: DataFrame,
    columns: Sequence[str],
    models: dict[Hashable, Model],
    id_col: str = "CustomerID",
) -> DataFrame:
    """``points`` with one integer label column, from 0, for each named model."""
    columns, names = list(columns), [str(n) for n in models]
    centers, groups = stacked(list(models.values()))
    sent = points.sparkSession.sparkContext.broadcast((centers, groups))

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = nearest_centers(batch[columns].to_numpy(dtype=float), *sent.value)
            yield batch.assign(**{n: lab for n, (lab, _) in zip(names, found)})

    kept = points.select(id_col, *columns)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema]
    return kept.mapInPandas(label, ", ".join(fields + [f"`{n}` int" for n in names]))


def fit_kmeans(
    points: DataFrame, columns: Sequence[str], k: int, seed: int = SEED, starts: int = STARTS
) -> Model:
    pools = {0: seed_pools(points, columns, [seed])[0]}
    models = starting_models(points.sparkSession, pools, [(0, k, seed)], starts)
    return fit_models(points, columns, models)[0]
