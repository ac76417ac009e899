"""Near-duplicate embeddings through a forest of random-projection trees with spill.

Vectors are compared within one label and one dimension. Each tree splits a node at the median
of a random projection; vectors within a margin of the median go to both sides (spill), the
margin being a quarter of the spread that the projections of a pair at the threshold differ by. Nodes of
more than LEAF_ROWS vectors are split again in the next round, by medians of a bounded sample of
the node, until all are leaves; a node that the margin does not let split is a leaf of any size.
So is a node whose middle half spreads little more than vectors at the threshold from each other
do: a cut through such a group of near copies would part many of its pairs, and each further one
more of them. All pairs of a leaf are compared exactly. A pair that shares several leaves counts in the first
of them only, so links are summed without listing pairs; of the pairs only a spanning forest
leaves the task. Leaves of many vectors are dealt to tasks as pairs of parts.

The forest is an index: it misses some pairs, and never links a pair below the threshold. Groups
of 5,000 near copies at cosines 0.93 to 0.97 must keep nine links of ten, which the tests measure
against brute force. Bounds: a node's sample has about SAMPLE rows; the trees hold medians and seeds only.

Exact copies (equal label and components) become one vector with a count first.

Nulls and ties: a vector that is null, zero, or holds null or non-finite components, and one
without a label or an id, links with nothing; without an id it has no component and is not kept.
Repeated rows are links of each other. Other columns are not read.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.functions.components import connected_components
from clientele.functions.unions import unite
from clientele.llm.common import run_starts, sorted_runs, store

THRESHOLD = 0.93
TREES = 6
LEAF_ROWS = 400
SAMPLE = 1024
#: Levels that one round splits a node by.
LEVELS = 6
#: A side with more than this share of the node makes the split useless.
MOST = 0.85
SEED = 42
#: Leaves beyond this size are compared in pairs of parts; see LONG_LISTS of the SimHash index.
LONG_LEAF = 4096
LONG_LEAVES = 10_000
TILE = 1024
#: A node is not split when the variance of its middle half is at most so many times that of a
#: group whose pairs lie at the threshold; measured along so many directions.
TIGHT = 1.7
TIGHT_DIRECTIONS = 8
#: Tiles with more near pairs than this tell by matrix products which of them count elsewhere.
MANY_PAIRS = 4096

_ROWS = "cid bigint, n bigint, node bigint, final boolean, vec binary"
_DOUBLES = "array<double>"


def _unit(vec: bytes) -> np.ndarray:
    x = np.frombuffer(vec, dtype=np.float64)
    scale = np.abs(x).max()
    x = x / scale
    return x / np.sqrt((x * x).sum())


def _units(vecs) -> np.ndarray:
    return np.array([_unit(v) for v in vecs])


def _packed(batches):
    """Vectors as bytes of doubles; null where they cannot be compared."""
    for batch in batches:
        out = []
        for v in batch.column("vec"):
            v = v.as_py()
            x = None if not v or any(c is None for c in v) else np.array(v, dtype=np.float64) + 0.0
            fit = x is not None and np.isfinite(x).all() and x.any()
            out.append(x.tobytes() if fit else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("label"), pa.array(out, pa.binary())],
            ["id", "label", "vec"],
        )


def _tight(units: np.ndarray, seed: int, threshold: float) -> bool:
    """Whether the middle half of the vectors lies about as close as pairs at the threshold.

    Vectors with pairwise cosine c project with variance (1 - c) / d on a random direction.
    """
    d = units.shape[1]
    ways = np.column_stack([_direction(seed ^ (i << 40), d) for i in range(1, TIGHT_DIRECTIONS + 1)])
    low, high = np.percentile(units @ ways, [25, 75], axis=0)
    spread = (high - low).mean() / 1.349
    return spread * spread * d <= TIGHT * (1 - threshold)


def _plan(units: np.ndarray, rows: int, seed: int, margin: float, threshold: float) -> list:
    """Splits of a node as (seed, median, left, right); a leaf is (None, number, stuck)."""
    plan: list = []
    leaves = 0

    def grow(part: np.ndarray, level: int, path: int) -> int:
        nonlocal leaves
        place = len(plan)
        plan.append(None)
        share = len(part) / len(units) * rows
        if share <= 0.75 * LEAF_ROWS or level == LEVELS or len(part) < 8:
            plan[place] = (None, leaves, False)
            leaves += 1
            return place
        if _tight(units[part], path ^ seed, threshold):
            plan[place] = (None, leaves, True)
            leaves += 1
            return place
        for attempt in range(4):
            own = (path * 4 + attempt) ^ seed
            side = units[part] @ _direction(own, units.shape[1])
            median = float(np.median(side))
            left, right = side <= median + margin, side >= median - margin
            if max(left.mean(), right.mean()) <= MOST:
                break
        else:
            plan[place] = (None, leaves, True)
            leaves += 1
            return place
        a = grow(part[left], level + 1, 2 * path)
        b = grow(part[right], level + 1, 2 * path + 1)
        plan[place] = (own, median, a, b)
        return place

    grow(np.arange(len(units)), 0, 1)
    return plan


def _direction(seed: int, d: int) -> np.ndarray:
    x = np.random.default_rng(seed & (2**63 - 1)).standard_normal(d)
    return x / np.sqrt((x * x).sum())


def _fit(threshold: float):
    def node(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("cid")
        units = _units(rows["vec"])
        margin = np.sqrt(2 - 2 * threshold) / np.sqrt(units.shape[1]) / 4
        own, size = int(rows["node"].iloc[0]), int(rows["size"].iloc[0])
        plan = _plan(units, size, own, margin, threshold)
        return pd.DataFrame({"node": [own], "plan": [pickle.dumps((plan, margin))]})

    return node


def _route(batches):
    """Each vector goes down its node's plan, along both sides within the margin."""
    for batch in batches:
        node = batch.column("node").to_numpy()
        vecs = batch.column("vec").to_pylist()
        plans = batch.column("plan")
        at, to, final = [], [], []
        order = np.argsort(node, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(node[order])) + 1) if len(order) else ():
            plan, margin = pickle.loads(plans[int(rows[0])].as_py())
            units = _units([vecs[r] for r in rows])
            own = int(node[rows[0]]).to_bytes(8, "little", signed=True)
            waiting = [(0, np.arange(len(rows)))]
            while waiting:
                place, part = waiting.pop()
                if not len(part):
                    continue
                step = plan[place]
                if step[0] is None:
                    child = xxhash.xxh64_intdigest(own + step[1].to_bytes(4, "little"))
                    at.extend(rows[part].tolist())
                    to.extend([child - 2**63] * len(part))
                    final.extend([step[2]] * len(part))
                    continue
                side = units[part] @ _direction(step[0], units.shape[1])
                waiting.append((step[2], part[side <= step[1] + margin]))
                waiting.append((step[3], part[side >= step[1] - margin]))
        take = pa.array(at, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("cid").take(take), batch.column("n").take(take),
             pa.array(to, pa.int64()), pa.array(final, pa.bool_()), batch.column("vec").take(take)],
            ["cid", "n", "node", "final", "vec"],
        )


def forest_leaves(classes: DataFrame, trees: int, threshold: float) -> DataFrame:
    """(cid, n, node, final, vec) for each leaf that holds a vector of ``classes``."""
    tree = F.explode(F.sequence(F.lit(1), F.lit(trees)))
    rows = classes.withColumn("tree", tree).select(
        "cid", "n", F.xxhash64("tree", "label", F.length("vec")).alias("node"),
        F.lit(False).alias("final"), "vec",
    )
    done, round_ = [], 0
    while True:
        sizes = rows.where(~F.col("final")).groupBy("node").agg(F.count("*").alias("size"))
        large = store(sizes.where(F.col("size") > LEAF_ROWS), "nodes")
        if large.isEmpty():
            done.append(rows)
            break
        draw = F.pmod(F.xxhash64("cid", F.lit(SEED + round_)), F.lit(1 << 30)) / float(1 << 30)
        sample = rows.where(~F.col("final")).join(large, "node").where(
            draw < F.lit(float(SAMPLE)) / F.col("size")
        )
        plans = store(
            sample.groupBy("node").applyInPandas(_fit(threshold), "node bigint, plan binary"),
            "plans",
        )
        done.append(rows.join(plans.select("node"), "node", "left_anti").select(*rows.columns))
        moved = rows.where(~F.col("final")).join(plans, "node").mapInArrow(_route, _ROWS)
        rows, round_ = store(moved, "nodes"), round_ + 1
    leaves = done[0]
    for more in done[1:]:
        leaves = leaves.unionByName(more)
    return leaves


def _compare(batches, threshold: float):
    for chunk in sorted_runs(batches, ["node", "lo", "hi"]):
        starts = run_starts(chunk["node"], chunk["lo"], chunk["hi"])
        for a, b in zip(starts, np.append(starts[1:], len(chunk["node"])), strict=True):
            if b - a < 2:
                continue
            cid, n, part = (chunk[c][a:b] for c in ("cid", "n", "part"))
            crossed = chunk["lo"][a] != chunk["hi"][a]
            links, root = _leaf_links(
                _units(chunk["vec"][a:b]), n, chunk["leaves"][a:b], int(chunk["node"][a]),
                part if crossed else None, threshold,
            )
            some = np.flatnonzero((links > 0) | (root != np.arange(len(root))))
            if len(some):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cid[some]), pa.array(links[some]), pa.array(cid[root[some]])],
                    ["cid", "links", "root"],
                )


def _leaf_links(units, n, leaves, node: int, part, threshold: float):
    """Links that this leaf counts for each of its vectors, and the class each one belongs to."""
    m = len(units)
    width = max(map(len, leaves))
    table = np.full((m, width), np.iinfo(np.int64).max, dtype=np.int64)
    for i, own in enumerate(leaves):
        table[i, : len(own)] = np.sort(own)
    links = np.zeros(m, dtype=np.int64)
    root = np.arange(m)
    for a in range(0, m, TILE):
        for b in range(a, m, TILE):
            cosines = units[a:a + TILE] @ units[b:b + TILE].T
            near = cosines >= threshold - 1e-9
            if part is not None:
                near &= part[a:a + TILE, None] != part[None, b:b + TILE]
            if a == b:
                near = np.triu(near, 1)
            if np.count_nonzero(near) > MANY_PAIRS:
                sure = near & (cosines >= threshold + 1e-9)
                near &= ~sure
                _unite_tile(root, sure, a, b)
                sure &= ~_share_before(table[a:a + TILE], table[b:b + TILE], node)
                links[a:a + TILE] += sure @ n[b:b + TILE]
                links[b:b + TILE] += sure.T @ n[a:a + TILE]
            i, j = np.nonzero(near)
            i, j = i + a, j + b
            for at in range(0, len(i), 1 << 16):
                x, y = i[at:at + (1 << 16)], j[at:at + (1 << 16)]
                held = (units[x] * units[y]).sum(axis=1) >= threshold
                x, y = x[held], y[held]
                first = _first_common(table[x], table[y]) == node
                np.add.at(links, x[first], n[y[first]])
                np.add.at(links, y[first], n[x[first]])
                unite(root, x, y)
    return links, root


def _unite_tile(root: np.ndarray, linked: np.ndarray, a: int, b: int) -> None:
    """Merge the sets of the linked pairs of a tile whose rows start at a, its columns at b."""
    for one, other, pairs in ((a, b, linked), (b, a, linked.T)):
        some = np.flatnonzero(pairs.any(axis=1))
        unite(root, some + one, pairs[some].argmax(axis=1) + other)
    rows, columns = linked.shape
    i, j = np.nonzero(linked & (root[a:a + rows, None] != root[None, b:b + columns]))
    unite(root, i + a, j + b)


def _share_before(one: np.ndarray, other: np.ndarray, node: int) -> np.ndarray:
    """Which pairs of rows of two tables share a leaf with a lesser number than ``node``."""
    shared = np.intersect1d(one[one < node], other[other < node])
    found = np.zeros((len(one), len(other)), dtype=bool)
    for at in range(0, len(shared), TILE):
        some = shared[at:at + TILE]
        marks = []
        for table in (one, other):
            place = np.minimum(np.searchsorted(some, table), len(some) - 1)
            i, k = np.nonzero(some[place] == table)
            mark = np.zeros((len(table), len(some)), dtype=np.float32)
            mark[i, place[i, k]] = 1
            marks.append(mark)
        found |= marks[0] @ marks[1].T > 0
    return found


def _first_common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least number that both rows hold; rows are sorted and padded with the largest long."""
    least = np.full(len(a), np.iinfo(np.int64).max)
    for k in range(b.shape[1]):
        held = (a == b[:, k, None]).any(axis=1)
        least = np.where(held, np.minimum(least, b[:, k]), least)
    return least


def near_links(leaves: DataFrame, threshold: float) -> DataFrame:
    """(cid, links, root): parts of each vector's links, and edges to its class in a leaf."""
    held = leaves.groupBy("cid").agg(F.collect_set("node").alias("leaves"))
    sizes = leaves.groupBy("node").agg(F.count("*").alias("rows")).where(F.col("rows") > LONG_LEAF)
    long = sizes.orderBy(F.desc("rows"), "node").limit(LONG_LEAVES).select(
        "node", F.ceil(F.col("rows") * 2 / LONG_LEAF).cast("int").alias("parts")
    )
    part = F.coalesce(F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int"), F.lit(0))
    dealt = (
        leaves.select("cid", "n", "node", "vec").distinct().join(held, "cid")
        .join(F.broadcast(long), "node", "left").withColumn("part", part)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
        .select("cid", "n", "node", "vec", "leaves", "part", F.least("part", "other").alias("lo"),
                F.greatest("part", "other").alias("hi"))
    )
    keys = ["node", "lo", "hi"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(
        lambda b: _compare(b, threshold), "cid bigint, links bigint, root bigint"
    )


def near_duplicates(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    threshold: float = THRESHOLD, trees: int = TREES,
) -> DataFrame:
    """One row per vector: ``id_col``, n_links, component_id, kept."""
    rows = df.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast(_DOUBLES).alias("vec"),
    )
    packed = store(rows.mapInArrow(_packed, "id bigint, label string, vec binary"), "vectors")
    fit = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull()
    named = packed.where(fit).withColumn("key", F.sha2(F.concat("vec", F.col("label").cast("binary")), 256))
    classes = store(
        named.groupBy("key").agg(F.min("id").alias("least"), F.count("*").alias("n"),
                                 F.first("label").alias("label"), F.first("vec").alias("vec"))
        .withColumn("cid", F.xxhash64("key")), "classes",
    )
    leaves = store(forest_leaves(classes, trees, threshold), "leaves")
    found = store(near_links(leaves, threshold), "links")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    edges = found.where(F.col("cid") != F.col("root")).select("cid", "root")
    groups = connected_components(edges, "cid", "root").withColumnRenamed("vertex", "cid")
    of_class = store(
        classes.select("key", "cid", "least", "n").join(links, "cid", "left")
        .join(groups, "cid", "left").select(
            "key", "least", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "cid").alias("group"),
        ), "classes",
    )
    least = of_class.groupBy("group").agg(F.min("least").alias("component_id"))
    of_class = store(of_class.join(least, "group").select("key", "n_links", "component_id"), "classes")
    alone = packed.where(~fit).select(
        "id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id")
    )
    every = named.join(of_class, "key").select("id", "n_links", "component_id").unionByName(alone)
    return every.select(
        F.col("id").alias(id_col), "n_links", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )


def op2_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{folder.rstrip('/')}/embeddings.parquet"))
