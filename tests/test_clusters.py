import math
import threading
import time
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from clientele.functions.agglomerate import (
    CoAssociation,
    Splits,
    Ward,
    agglomerate_table,
    merge_block,
    merges_of,
    nearest_units,
)
from clientele.functions.blocks import distance_tiles, plane_tiles, within_tiles
from clientele.functions.components import connected_components
from clientele.functions.labels import renumber
from clientele.operators import (
    clustering,
    density,
    kmeans,
    metrics,
    mixture,
    profiles,
    selection,
)
from clientele.plans import analysis

COLUMNS = ["x", "y"]


def blobs(rows=60, gap=8.0, seed=0, k=3):
    rng = np.random.default_rng(seed)
    true = np.repeat(np.arange(k), rows)
    data = rng.normal(size=(k * rows, 2)) + gap * np.column_stack([true, true % 2])
    return data, true


def points_of(spark, data, **labels):
    table = pd.DataFrame(data, columns=COLUMNS)
    table.insert(0, "CustomerID", [f"{i:05d}" for i in range(len(data))])
    return spark.createDataFrame(table.assign(**labels)).repartition(4)


def same_partition(one, other):
    return len(set(zip(one, other))) == len(set(one)) == len(set(other))


def labels_of(df):
    return [r.cluster for r in df.orderBy("CustomerID").collect()]


def distances(data):
    return np.sqrt(((data[:, None] - data[None]) ** 2).sum(-1))


def brute_silhouette(gaps, label):
    out = []
    for i, own in enumerate(label):
        if (label == own).sum() == 1:
            out.append(0.0)
            continue
        a = gaps[i, label == own].sum() / ((label == own).sum() - 1)
        b = min(gaps[i, label == c].mean() for c in set(label) - {own})
        out.append((b - a) / max(a, b))
    return np.array(out)


@pytest.mark.parametrize("method", [
    lambda p: clustering.kmeans(p, COLUMNS, 3),
    lambda p: clustering.hierarchical(p, COLUMNS, 3),
    lambda p: clustering.hierarchical(p, COLUMNS, 3, small_clusters=20),
    lambda p: clustering.hierarchical(p, COLUMNS, 3, block_units=20),
    lambda p: clustering.gaussian_mixture(p, COLUMNS, 3),
    lambda p: clustering.consensus_clustering(p, COLUMNS, 3, runs=4),
    lambda p: density.dbscan(p, COLUMNS, 1.5),
])
def test_methods_find_the_blobs(spark, method):
    data, true = blobs()
    found = labels_of(method(points_of(spark, data)))
    kept = [i for i, f in enumerate(found) if f != -1]
    assert len(kept) > 170
    assert same_partition([found[i] for i in kept], true[kept])


def test_kmeans_is_repeatable_and_no_worse_than_one_start(spark):
    data, _ = blobs(gap=2.0, k=5)
    points = points_of(spark, data)
    best = kmeans.fit_kmeans(points, COLUMNS, 5)
    single = kmeans.fit_kmeans(points, COLUMNS, 5, starts=1)
    assert best.cost <= single.cost + 1e-9
    gaps = ((data[:, None] - best.centers[None]) ** 2).sum(-1)
    assert math.isclose(best.cost, gaps.min(axis=1).sum(), rel_tol=1e-9)
    first, second = (labels_of(clustering.kmeans(points, COLUMNS, 5)) for _ in range(2))
    assert first == second and set(first) == {1, 2, 3, 4, 5}


def test_kmeans_finds_a_rare_far_cluster(spark):
    rng = np.random.default_rng(5)
    data = np.vstack([rng.normal(size=(40_000, 2)), rng.normal(size=(4, 2)) + 500.0])
    found = labels_of(clustering.kmeans(points_of(spark, data), COLUMNS, 2))
    assert found[:40_000] == [1] * 40_000 and found[40_000:] == [2] * 4


def test_pools_cover_all_rows_and_do_not_depend_on_the_layout(spark):
    data, _ = blobs()
    points = points_of(spark, data)
    first, other = kmeans.seed_pools(points, COLUMNS, [1, 2])
    again = kmeans.seed_pools(points.repartition(7), COLUMNS, [1])[0]
    assert first[1].sum() == other[1].sum() == len(data)
    assert np.array_equal(first[0], again[0]) and np.array_equal(first[1], again[1])


def merge_by_force(weights, states, linkage):
    """Agglomeration over all pairs of clusters, one merge at a time: (unit, near, gap).

    A cluster has the place of its greatest member; ties go by (greater place, lesser place).
    """
    clusters = {i: (float(w), np.array(x, dtype=float)) for i, (w, x) in enumerate(zip(weights, states))}
    merges = []
    while len(clusters) > 1:
        places = sorted(clusters)
        w = np.array([clusters[i][0] for i in places])
        x = np.array([clusters[i][1] for i in places])
        gaps = linkage.gap(w, x, w, x)
        gap, high, low = min(
            (gaps[a, b], places[b], places[a])
            for a in range(len(places)) for b in range(a + 1, len(places))
        )
        one, two = clusters.pop(low), clusters[high]
        state = linkage.join(np.array([one[0]]), one[1][None], np.array([two[0]]), two[1][None])[0]
        clusters[high] = (one[0] + two[0], state)
        merges.append((low, high, float(gap)))
    return merges


def signed_units(seed, units, runs, k):
    """Distinct random signatures as label counts, with weights."""
    rng = np.random.default_rng(seed)
    signed = np.unique(rng.integers(0, k, (units, runs)), axis=0)
    weights = rng.integers(1, 5, len(signed)).astype(float)
    return weights, (signed[:, :, None] == np.arange(k)).reshape(len(signed), -1).astype(float)


def ward_units(seed, units, lattice):
    rng = np.random.default_rng(seed)
    data = rng.integers(0, 5, (units, 2)).astype(float) if lattice else rng.normal(size=(units, 2))
    data = np.unique(data, axis=0)
    return rng.integers(1, 4, len(data)).astype(float), data


CASES = [
    (Ward(), *ward_units(1, 60, False)), (Ward(), *ward_units(2, 60, True)),
    (CoAssociation(5), *signed_units(3, 60, 5, 3)), (CoAssociation(10), *signed_units(4, 50, 10, 2)),
]


def test_ward_gap_is_the_growth_of_the_inner_squares():
    weights, data = ward_units(5, 6, False)
    rows = np.repeat(np.arange(len(data)), weights.astype(int))
    gaps = Ward().gap(weights, data, weights, data)

    def inner(units):
        own = data[rows[np.isin(rows, units)]]
        return ((own - own.mean(axis=0)) ** 2).sum()

    assert np.isclose(gaps[0, 1], inner([0, 1]) - inner([0]) - inner([1]))


def test_coassociation_is_the_mean_share_of_runs_that_differ():
    weights, shares = signed_units(6, 8, 4, 3)
    states = shares * weights[:, None]
    one, two = states[[0]] + states[[1]], states[[2]]
    gap = CoAssociation(4).gap(weights[[0]] + weights[[1]], one, weights[[2]], two)[0, 0]
    apart = 1 - shares @ shares.T / 4
    assert np.isclose(gap, (weights[0] * apart[0, 2] + weights[1] * apart[1, 2]) / (weights[0] + weights[1]))


@pytest.mark.parametrize("linkage, weights, values", CASES)
@pytest.mark.parametrize("block_units", [1_000, 25, 7])
def test_the_tree_does_not_depend_on_the_blocks(spark, linkage, weights, values, block_units):
    """Heights, members and ties as one merge at a time gives them."""
    columns = [f"c{j}" for j in range(values.shape[1])]
    table = pd.DataFrame(values, columns=columns).assign(
        unit=[f"u{i:04d}" for i in range(len(values))], weight=weights
    )
    states = values if isinstance(linkage, Ward) else values * weights[:, None]
    want = {(f"u{a:04d}", f"u{b:04d}", g) for a, b, g in merge_by_force(weights, states, linkage)}
    merges = merges_of(spark.createDataFrame(table).repartition(3), columns, linkage, block_units)
    assert {(r.unit, r.near, r.gap) for r in merges.collect()} == want


@pytest.mark.parametrize("k", [1, 2, 5, 9])
def test_cutting_the_tree(spark, k):
    """A pair that merges inside a block and is cut again, and rows that are equal."""
    data, _ = blobs(rows=40, gap=1.5, seed=7)
    data = np.vstack([data, [[40.0, 40.0], [45.0, 45.0]], data[:30], data[:1]])
    distinct, weights = np.unique(data, axis=0, return_counts=True)
    merges = merge_by_force(weights, distinct, Ward())
    label = np.arange(len(distinct))
    for low, high, _ in merges[:len(merges) - k + 1]:
        label[label == label[low]] = label[high]
    rows = [int(np.flatnonzero((distinct == row).all(axis=1))[0]) for row in data]
    found = labels_of(clustering.hierarchical(points_of(spark, data), COLUMNS, k, block_units=12))
    assert len(set(found)) == k and same_partition(found, label[rows])


def test_one_unit_and_equal_units(spark):
    one = spark.createDataFrame([("a", 1.0, 0.5)], "unit string, weight double, x double")
    assert [tuple(r) for r in agglomerate_table(one, ["x"], 3, Ward()).collect()] == [("a", "a")]
    far = spark.createDataFrame(
        [(f"{i}", 1.0, 1e12 * (i % 2) + i) for i in range(40)], "unit string, weight double, x double"
    )
    labels = {r.unit: r.label for r in agglomerate_table(far, ["x"], 2, Ward(), 5).collect()}
    assert len({labels[str(i)] for i in range(0, 40, 2)}) == 1 and len(set(labels.values())) == 2


def test_safe_merges_only():
    """A unit whose nearest one lies outside does not merge inside."""
    data = np.array([[0.0], [1.0], [1.5], [9.0], [9.1]])
    outs = np.array([0.1, 5.0, 5.0, 0.002, np.inf])
    alive, _, _, _, merges = merge_block(np.ones(5), data, Ward(), outs, np.zeros(5, dtype=int))
    assert [(a.tolist(), b.tolist()) for a, b, _ in merges] == [([1], [2])]
    assert alive.tolist() == [True, False, True, True, True]


@pytest.mark.parametrize("scale, shift", [(1.0, 0.0), (1e-3, 1e5), (1e200, 0.0)])
def test_nearest_units_are_those_of_the_differences(scale, shift):
    """Products only choose who is compared: gaps and ties are as from differences."""
    rng = np.random.default_rng(7)
    data = rng.integers(0, 4, (200, 3)) * 0.1 * scale + shift
    weights = rng.integers(1, 4, 200).astype(float)
    with np.errstate(over="ignore", invalid="ignore"):
        wanted = Ward().gap(weights[:80], data[:80], weights[80:], data[80:])
        at, gap = nearest_units(weights[:80], data[:80], weights[80:], data[80:], Ward())
    assert np.array_equal(at, wanted.argmin(axis=1)) and np.array_equal(gap, wanted.min(axis=1))


def test_blocks_of_a_tree_of_splits_are_even():
    rng, wide = np.random.default_rng(3), np.full(2, np.inf)
    data, tree = rng.random((4_500, 2)), Splits()
    tree.grow(data, 45, -wide, wide, rng)
    sizes = np.bincount(tree.locate(data), minlength=45)
    assert tree.blocks == 45 and sizes.min() > 80 and sizes.max() < 120


def test_consensus_in_rounds(spark):
    data, true = blobs(gap=4.0)
    points = points_of(spark, data)
    one, other = (
        labels_of(clustering.consensus_clustering(points, COLUMNS, 3, runs=3, block_units=n))
        for n in (3, 1000)
    )
    assert same_partition(one, other)


def test_coassociation(spark):
    df = spark.createDataFrame([([1, 2, 3, 4], [1, 2, 0, 0])], "a array<int>, b array<int>")
    assert df.select(clustering.coassociation("a", "b")).first()[0] == 0.5


def brute_dbscan(data, eps, min_samples):
    near = distances(data) <= eps
    core = near.sum(axis=1) >= min_samples
    label = np.full(len(data), -1)
    for i in np.flatnonzero(core):
        if label[i] == -1:
            stack, label[i] = [i], i
            while stack:
                for j in np.flatnonzero(near[stack.pop()] & core):
                    if label[j] == -1:
                        label[j] = i
                        stack.append(j)
    for i in np.flatnonzero(~core):
        reached = label[near[i] & core]
        label[i] = reached.min() if len(reached) else -1
    return label, core


def crowds(kind):
    rng = np.random.default_rng(6)
    if kind == "even":
        data = rng.uniform(0, 6, size=(250, 2))
        data[100:180] = data[100]  # a heap of copies
        return data
    # Heaps of distinct points that touch, nearly touch, and a thin bridge between two of them.
    heaps = [rng.normal(size=(60, 2)) * 0.08 + at for at in ([0, 0], [0.7, 0], [3, 3], [3.9, 3.9])]
    bridge = np.column_stack([np.linspace(0.8, 2.9, 9), np.linspace(0.1, 2.9, 9)])
    far = np.array([[1e7, -1e7], [1e7, -1e7 + 0.3], [-3e6, 0]])
    return np.vstack([*heaps, bridge, far, rng.uniform(-1, 5, size=(30, 2))])


@pytest.mark.parametrize("kind", ["even", "heaps"])
@pytest.mark.parametrize("block_points, part_points", [(1_000, 100_000), (20, 60), (5, 1_000)])
def test_dbscan_by_force(spark, monkeypatch, kind, block_points, part_points):
    """Tiny blocks and parts split heaps, visits and components across tasks."""
    monkeypatch.setattr(density, "PART_POINTS", part_points)
    data = crowds(kind)
    points = points_of(spark, data)
    label, core = brute_dbscan(data, 0.5, 5)
    flags = density.neighbor_counts(points, COLUMNS, block_points=block_points)
    flags = flags.orderBy("CustomerID").collect()
    assert [r.is_core for r in flags] == core.tolist()
    assert [r.neighbors for r in flags] == (distances(data) <= 0.5).sum(axis=1).tolist()
    found = np.array(labels_of(density.dbscan(points, COLUMNS, block_points=block_points)))
    assert (found == -1).tolist() == (label == -1).tolist()
    assert same_partition(found[label != -1], label[label != -1])


@pytest.mark.parametrize("scale, shift", [(1.0, 0.0), (1e-3, 1e5), (1.0, np.inf)])
def test_rows_within_a_radius_are_those_of_the_differences(scale, shift):
    rng = np.random.default_rng(4)
    # Many distances are the radius itself, where a product's rounding would decide.
    data = rng.integers(0, 5, (300, 4)) * 0.25 * scale
    data[0] += shift
    data[1:] += shift if np.isfinite(shift) else 0.0
    one, other = data[:120], data[120:]
    found = [near for _, near in within_tiles(one, other, 0.5 * scale)]
    wanted = [gaps <= 0.5 * scale for _, gaps in distance_tiles(one, other)]
    assert np.array_equal(np.vstack(found), np.vstack(wanted))


def test_tight_groups_hold_neighbours_only():
    data = np.random.default_rng(3).normal(size=(500, 3))
    group = density.tight_groups(data, 0.4)
    gaps = distances(data)
    assert all(gaps[np.ix_(group == g, group == g)].max() <= 0.8 for g in set(group))
    assert (density.tight_groups(np.zeros((50, 2)), 0.1) == 0).all()


def test_dbscan_of_a_heap_and_a_far_value_ends_soon(spark):
    """20,000 distinct points within the radius are few links; a far value changes nothing."""
    rng = np.random.default_rng(4)
    turn = rng.uniform(0, 2 * np.pi, 20_000)
    heap = np.column_stack([np.cos(turn), np.sin(turn)]) * np.sqrt(rng.uniform(0, 0.06, (20_000, 1)))
    data = np.vstack([heap, [[1e6, 0.0]]])
    points = points_of(spark, data)
    merged = density.merged_points(points, COLUMNS, "CustomerID")
    parts = density._Density(merged, COLUMNS, 0.5, 5, points.schema["CustomerID"].dataType, 1_000)
    assert parts.points.groupBy("_block").count().agg(F.max("count")).first()[0] < 4_000
    assert parts.points.where("_group IS NULL").count() < 50
    assert parts.group_links().count() < 5_000
    found = labels_of(density.dbscan(points, COLUMNS))
    assert found == [0] * 20_000 + [-1]


def test_components_of_a_long_chain(spark):
    edges = [(f"{i:03d}", f"{i + 1:03d}") for i in range(60) if i != 30]
    df = spark.createDataFrame(edges, "a string, b string")
    found = {r.vertex: r.component for r in connected_components(df, "a", "b").collect()}
    assert len(found) == 61
    assert {v: c for v, c in found.items() if c not in ("000", "031")} == {}
    assert found["030"] == "000" and found["060"] == "031"


def test_renumber(spark):
    df = spark.createDataFrame(
        [("a", 9), ("b", 4), ("c", 4), ("d", None), ("e", 7)], "CustomerID string, l int"
    )
    assert labels_of(renumber(df, "l")) == [2, 1, 1, -1, 3]


@pytest.mark.parametrize("limits", [
    {}, {"BLOCK_ROWS": 50}, {"MOST_CLUSTERS": 1, "MOST_CENTERS": 1},
    {"MOST_CLUSTERS": 1, "PAIR_ROWS": 25},
], ids=["sums", "small blocks", "many clusters", "clusters larger than a block"])
def test_silhouettes_by_force(spark, monkeypatch, limits):
    data, true = blobs(gap=2.0)
    label = true.copy()
    label[0], label[5:9] = 7, -1
    label[20:60] = 100 + np.arange(40) // 3
    points = points_of(spark, data, one=label, two=true)
    kept = label != -1
    for name, value in limits.items():
        monkeypatch.setattr(metrics, name, value)
    for distance, power in (("euclidean", 1), ("squared", 2)):
        rows = metrics.silhouette_samples(points, COLUMNS, ["one", "two"], distance=distance)
        table = rows.orderBy("CustomerID").toPandas()
        gaps = distances(data) ** power
        for name, lab, at in (("one", label, kept), ("two", true, kept | True)):
            found = table[table["labeling"] == name]["silhouette"].to_numpy()
            wanted = brute_silhouette(gaps[np.ix_(at, at)], lab[at])
            assert np.allclose(found, wanted, atol=1e-9)
        assert {r.distance for r in rows.select("distance").distinct().collect()} == {distance}
    with pytest.raises(ValueError):
        metrics.silhouette_samples(points, COLUMNS, ["two"], distance="city")


def brute_davies_bouldin(data, label):
    found = sorted(set(label) - {-1})
    centers = np.array([data[label == c].mean(axis=0) for c in found])
    scatter = np.array([
        np.sqrt(((data[label == c] - m) ** 2).sum(axis=1)).mean() for c, m in zip(found, centers)
    ])
    apart = distances(centers)
    ratio = np.divide(
        scatter[:, None] + scatter, apart, out=np.zeros_like(apart), where=apart > 0
    )
    np.fill_diagonal(ratio, 0)
    return ratio.max(axis=1).mean()


@pytest.mark.parametrize("block_clusters", [1_000, 16, 3])
def test_davies_bouldin_of_many_clusters_by_force(spark, monkeypatch, block_clusters):
    """Far clusters with a large scatter are the worst partners of many blocks."""
    rng = np.random.default_rng(8)
    data = np.vstack([rng.normal(size=(400, 2)) * 20, rng.normal(size=(30, 2)) * 40 + 300])
    label = np.concatenate([np.arange(400) // 4, np.full(30, 777)])
    label[4:8] = label[:4] + 500
    data[8:12], data[12:16] = data[8], data[8]
    monkeypatch.setattr(metrics, "worst_partners", lambda s, m, f=metrics.worst_partners: f(
        s, m, block_clusters
    ))
    points = points_of(spark, data, many=label, few=np.arange(len(data)) % 3 - 1)
    found = {r.labeling: r.davies_bouldin for r in metrics.davies_bouldin(
        points, COLUMNS, ["many", "few"]
    ).collect()}
    assert math.isclose(found["many"], brute_davies_bouldin(data, label), rel_tol=1e-9)
    few = np.arange(len(data)) % 3 - 1
    assert math.isclose(found["few"], brute_davies_bouldin(data, few), rel_tol=1e-9)


def test_one_label_has_no_silhouette(spark):
    data, _ = blobs()
    points = points_of(spark, data)
    model = kmeans.Model(np.array([data.mean(axis=0)] * 2))
    row = selection._quality(points, COLUMNS, {(0, 2): model}).first()
    assert row.silhouette == -1.0


def test_the_mixture_gains_likelihood_and_takes_the_likeliest(spark):
    data, _ = blobs(gap=3.0)
    points = points_of(spark, data)
    start = kmeans.fit_kmeans(points, COLUMNS, 3)
    fitted = mixture.fit_mixture(points, COLUMNS, start)
    steps = np.diff(fitted.likelihoods)
    assert (steps > -1e-9).all() and steps[-1] < mixture.GAIN
    assert math.isclose(fitted.weights.sum(), 1.0)
    logs = fitted.log_densities(data)
    total = np.log(np.exp(logs).sum(axis=1)).mean()
    assert math.isclose(total, fitted.likelihoods[-1], rel_tol=1e-9)
    found = mixture.assign_mixture(points, COLUMNS, fitted).orderBy("CustomerID").toPandas()
    assert found["label"].tolist() == logs.argmax(axis=1).tolist()


def test_sweep_and_gap(spark):
    data, _ = blobs(gap=12.0, k=4)
    points = points_of(spark, data)
    table = selection.k_metrics(points, COLUMNS, 6).toPandas().sort_values("k")
    assert table["k"].tolist() == [2, 3, 4, 5, 6]
    assert table.set_index("k")["silhouette"].idxmax() == 4
    assert table["wcss"].is_monotonic_decreasing
    assert np.isfinite(table["gap_statistic"]).all()


def test_choice_of_k(spark):
    rows = [
        (2, 0.40, 2065.0, 1.5, 3.0, 9.0), (3, 0.30, 1800.0, 1.4, 3.5, 8.0),
        (4, 0.28, 1500.0, 1.3, 3.9, 7.0), (5, 0.27, 1433.0, 1.216, 4.0, 6.0),
        (8, 0.20, 1100.0, 1.4, 4.281, 5.0),
    ]
    schema = "k int, silhouette double, calinski_harabasz double, davies_bouldin double, " \
        "gap_statistic double, wcss double"
    table = spark.createDataFrame(rows, schema)
    best = {r.metric: r.optimal_k for r in selection.optimal_k_table(table).collect()}
    assert (best["Silhouette"], best["Calinski-Harabasz"], best["Davies-Bouldin"]) == (2, 2, 5)
    assert best["Gap Statistic"] == 8
    by_hand = {
        k: 0.3 * (s - 0.2) / 0.2 + 0.2 * (c - 1100) / 965 + 0.2 * (1 - (d - 1.216) / 0.284)
        + 0.3 * (g - 3.0) / 1.281
        for k, s, c, d, g, _ in rows
    }
    assert best["Consensus"] == max(by_hand, key=by_hand.get)
    # A tie goes to the least k; outside 3..7 the default is used.
    tied = spark.createDataFrame([(k, 0.5, 1.0, 1.0, 1.0, 1.0) for k in (2, 3)], schema)
    assert selection.consensus_k(tied).first().k == 2
    assert selection.selected_k(tied) == 5


def test_reference_sets(spark):
    points = points_of(spark, blobs()[0])
    box = selection.reference_sets(points, COLUMNS, 3)
    again = selection.reference_sets(points.repartition(7), COLUMNS, 3)
    assert box.groupBy("part").count().where("count = 180").count() == 3
    assert box.exceptAll(again).isEmpty()
    low, high = points.agg(F.min(F.least(*COLUMNS)), F.max(F.greatest(*COLUMNS))).first()
    assert box.where((F.col("x") < low) | (F.col("x") > high)).isEmpty()


def test_pca_by_force(spark):
    data = blobs()[0] @ np.array([[3.0, 0.5], [0.2, 1.0]])
    values, vectors = np.linalg.eigh(np.cov(data.T))
    points = points_of(spark, data)
    shares = [r.explained_variance for r in profiles.pca_variance(points, COLUMNS).collect()]
    assert np.allclose(shares, values[::-1] / values.sum())
    found = profiles.pca_projection(points, COLUMNS).orderBy("CustomerID").toPandas()
    first = (data - data.mean(axis=0)) @ vectors[:, -1]
    assert np.allclose(np.abs(found["pc1"]), np.abs(first))


def test_plane_tiles_keep_the_digits_of_close_rows():
    """Products lose the digits of near rows far from the middle; those and odd rows count."""
    rng = np.random.default_rng(6)
    one = rng.lognormal(size=(700, 10)) * 3
    other = np.vstack([
        one[:90], one[:200] * (1 + 1e-9), rng.lognormal(size=(300, 10)),
        1e6 + rng.normal(size=(40, 10)), np.full((1, 10), np.inf), np.full((1, 10), np.nan),
    ])
    other[:90][::2] += 1e-7
    for left, right in ((one, other), (other, other)):
        found = np.full((len(left), len(right)), -1.0)
        for rows, cols, gaps in plane_tiles(left, right):
            found[rows, cols] = gaps
        with np.errstate(invalid="ignore"):
            wanted = np.sqrt(((left[:, None] - right) ** 2).sum(axis=2))
        assert np.allclose(found, wanted, rtol=1e-10, atol=0, equal_nan=True)


@pytest.mark.parametrize("most_runs", [8, 0])
def test_few_clusters_share_one_pass(spark, monkeypatch, most_runs):
    """A labeling with many clusters takes a pass of its own; the others still share theirs."""
    data, true = blobs(gap=2.0)
    many = np.arange(len(data)) // 4
    few = true.copy()
    few[::9] = -1
    true[::18] = -1
    monkeypatch.setattr(metrics, "MOST_CLUSTERS", 20)
    monkeypatch.setattr(metrics, "MOST_RUNS", most_runs)
    shared = []
    by_sums = metrics._by_sums
    monkeypatch.setattr(
        metrics, "_by_sums", lambda p, c, names, *rest: shared.append(names) or by_sums(p, c, names, *rest)
    )
    points = points_of(spark, data, true=true, many=many, few=few)
    table = metrics.silhouette_samples(points, COLUMNS, ["true", "many", "few"]).orderBy(
        "CustomerID"
    ).toPandas()
    assert shared == [["true", "few"]]
    gaps = distances(data)
    for name, lab in (("true", true), ("many", many), ("few", few)):
        at = lab != -1
        found = table[table["labeling"] == name]["silhouette"].to_numpy()
        assert np.allclose(found, brute_silhouette(gaps[np.ix_(at, at)], lab[at]), atol=1e-9)


def test_tiles_end_where_the_labels_change():
    """A tile of a long run has one kind of rows on each side; short runs share tiles."""
    rng = np.random.default_rng(8)
    label = np.repeat([0, 1, 2, 3, 4, 5], [700, 3, 5, 130, 2, 300])[:, None]
    data = rng.normal(size=(len(label), 3))
    kinds = metrics._Kinds(label, 6)
    cuts = kinds.cuts()
    assert np.concatenate([np.arange(len(label))[cut] for cut in cuts]).tolist() == list(range(len(label)))
    assert [len(set(label[cut, 0])) for cut in cuts] == [1, 1, 1, 2, 1, 1, 1, 1]
    gaps = distances(data)
    wanted = np.stack([gaps[:, label[:, 0] == c].sum(axis=1) for c in range(6)])
    for mirrored in (False, True):
        sums = np.zeros((6, len(label)))
        for rows, cols, tile in plane_tiles(data, data, mirrored, cuts, cuts):
            kinds.add(sums[:, rows], cols, tile.T)
            if mirrored and rows != cols:
                kinds.add(sums[:, cols], rows, tile)
        assert np.allclose(sums, wanted, rtol=1e-12)


def test_each_pair_of_blocks_has_a_partition(spark):
    """Hashed pairs share partitions, and one task then does the work of several."""
    rows = spark.range(600).withColumn("at", F.col("id") % 6)

    def work(one, other):
        here = TaskContext.get().partitionId()
        return pd.DataFrame({"partition": [here], "n": [len(one) + len(one if other is None else other)]})

    found = metrics._in_pairs(rows, F.col("at"), 6, work, "partition int, n bigint").collect()
    assert sorted(r.partition for r in found) == list(range(21))
    assert {r.n for r in found} == {200}


def test_dbscan_compares_no_groups_that_are_joined_already(spark, monkeypatch):
    """A dense band of tight groups is joined by its envoys; only two that may lie apart meet."""
    rng = np.random.default_rng(11)
    data = np.vstack([rng.uniform(0, 1, (3_000, 2)) * [6, 2], rng.uniform(0, 1, (60, 2)) * 0.2 + [9, 9]])
    points = points_of(spark, data)
    stored = {}
    write = density.materialize

    def keep(df, label):
        stored[label] = write(df, label)
        return stored[label]

    monkeypatch.setattr(density, "materialize", keep)
    found = labels_of(density.dbscan(points, COLUMNS, block_points=200))
    assert found == [0] * 3_000 + [1] * 60
    groups = stored["groups"]
    assert groups.where("not linked").count() > 0
    assert stored["open"].count() == 0


def test_centers_meet_rows_in_tiles_of_bounded_size():
    rng = np.random.default_rng(5)
    data = rng.integers(-3, 4, size=(60_000, 3)).astype(float)
    centers = rng.integers(-3, 4, size=(120, 3)).astype(float)
    centers[1] = centers[0]  # Equal centres: the first one has the rows.
    groups = [slice(0, 3), slice(3, 50), slice(50, 120)]
    tracemalloc.start()
    found = list(kmeans.nearest_centers(data, centers, groups, second=True))
    sums = kmeans.cluster_sums(data, centers, groups)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    # All distances at once are 58 MB.
    assert peak < 24 << 20
    for group, (label, gap, other) in zip(groups, found):
        apart = ((data[:, None, :] - centers[None, group, :]) ** 2).sum(axis=2)
        assert (label == apart.argmin(axis=1)).all()
        ranked = np.sort(apart, axis=1)
        assert np.allclose(gap, ranked[:, 0], atol=1e-9)
        assert np.allclose(other, ranked[:, 1], atol=1e-9)
        own = (label == np.arange(group.stop - group.start)[:, None]).astype(float)
        expected = np.column_stack([own.sum(axis=1), own @ gap, own @ data])
        assert np.allclose(sums[group], expected, atol=1e-6)


def test_candidates_meet_rows_in_tiles_of_bounded_size():
    rng = np.random.default_rng(6)
    data, pool = rng.normal(size=(2_000, 4)), rng.normal(size=(3_000, 4))
    tracemalloc.start()
    label, gap = kmeans._nearest(data, pool)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    # All distances at once are 48 MB.
    assert peak < 12 << 20
    apart = ((data[:100, None, :] - pool) ** 2).sum(axis=2)
    assert (label[:100] == apart.argmin(axis=1)).all() and np.allclose(gap[:100], apart.min(axis=1))


@pytest.mark.parametrize("broken", ["hierarchical", "gaussian_mixture"])
def test_a_method_that_fails_is_no_result(spark, monkeypatch, broken):
    def fails(*_, **__):
        raise ArithmeticError("no such fit")

    monkeypatch.setattr(clustering, broken, fails)
    with pytest.raises(ArithmeticError, match="no such fit"):
        analysis.fit_all(
            points_of(spark, blobs(rows=20)[0]), COLUMNS, 3, methods=["Agglomerative", "GaussianMixture"]
        )


@pytest.mark.parametrize("limits", [
    {"PACK_ROWS": 16, "BLOCK_ROWS": 50}, {"PACK_ROWS": 7, "BLOCK_SUMS": 200}, {"PACK_ROWS": 1},
])
def test_silhouettes_copy_no_row_for_each_block(spark, monkeypatch, limits):
    """Blocks meet as partitions of packed rows; what is shuffled does not hold the rows again."""
    for name, value in limits.items():
        monkeypatch.setattr(metrics, name, value)
    data, true = blobs(rows=70, gap=2.0)
    few = np.where(np.arange(len(data)) % 9 == 0, -1, true % 2)
    other = np.arange(len(data)) * 7 % 5
    points = points_of(spark, data, true=true, few=few, other=other)
    rows = metrics.silhouette_samples(points, COLUMNS, ["true", "few", "other"])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "explode" not in plan
    table, gaps = rows.orderBy("CustomerID").toPandas(), distances(data)
    for name, lab in (("true", true), ("few", few), ("other", other)):
        at = lab != -1
        found = table[table["labeling"] == name]
        assert (found["cluster"].to_numpy() == lab[at]).all()
        wanted = brute_silhouette(gaps[np.ix_(at, at)], lab[at])
        assert np.allclose(found["silhouette"].to_numpy(), wanted, atol=1e-9)


def test_silhouettes_of_numbers_and_missing_ids(spark):
    """Ids of any type come back as they were, a missing one too."""
    data, true = blobs(rows=30, gap=2.0)
    points = points_of(spark, data, true=true).withColumn(
        "CustomerID", F.expr("CASE WHEN CustomerID <> '00003' THEN CAST(CustomerID AS BIGINT) END")
    )
    rows = metrics.silhouette_samples(points, COLUMNS, ["true"])
    assert rows.schema["CustomerID"].dataType.simpleString() == "bigint"
    found = {r.CustomerID: r.silhouette for r in rows.collect()}
    wanted = brute_silhouette(distances(data), true)
    assert set(found) == ({*range(90)} - {3}) | {None}
    assert all(math.isclose(found[None if i == 3 else i], w, abs_tol=1e-9) for i, w in enumerate(wanted))


def test_runs_are_summed_by_any_plan(monkeypatch):
    rng = np.random.default_rng(4)
    label = np.sort(rng.integers(0, 40, size=(300, 1)), axis=0)
    gaps = rng.random((300, 300))
    for most in (100, 24, 1, 0):
        monkeypatch.setattr(metrics, "MOST_RUNS", most)
        monkeypatch.setattr(metrics, "RUN_ROWS", 1_000)
        kinds = metrics._Kinds(label, 40)
        for tile in (gaps, np.asfortranarray(gaps)):
            sums = np.zeros((40, 300))
            for cut in kinds.cuts():
                kinds.add(sums, cut, tile[cut])
            wanted = np.stack([gaps[label[:, 0] == c].sum(axis=0) for c in range(40)])
            assert np.allclose(sums, wanted, rtol=1e-12)


def test_only_crowded_blocks_are_copied(spark, monkeypatch):
    """Points of blocks that few others visit are sent once, whatever the size of the table."""
    monkeypatch.setattr(density, "PART_POINTS", 200)
    rng = np.random.default_rng(3)
    data = rng.normal(size=(1_000, 2)) * 0.1 + 50 * np.repeat(rng.permutation(40), 25)[:, None]
    data[:300] = rng.normal(size=(300, 2)) * 0.1 - 1_000
    merged = density.merged_points(points_of(spark, data), COLUMNS, "CustomerID")
    placed = density._Density(merged, COLUMNS, 1.0, 5, merged.schema["_rep"].dataType, 100)

    def work(guests, homes):
        return pd.DataFrame({"far": homes["x"][homes["x"] > -500].count(), "n": len(homes)}, index=[0])

    met = placed.met(
        placed.points.withColumn("_reach", F.lit(1.0)), placed.points, work, "far bigint, n bigint"
    ).agg(F.sum("far").alias("far"), F.sum("n").alias("n")).first()
    # Blocks of the heap, and a few larger ones, meet in parts; five of all before.
    assert 700 <= met.far < 1_400 and met.n < 2 * len(data), met


@pytest.mark.parametrize("joint, part_points", [(1, 100_000), (3, 100_000), (16, 60)])
def test_neighbours_in_tasks_of_several_blocks(spark, monkeypatch, joint, part_points):
    monkeypatch.setattr(density, "PART_POINTS", part_points)
    data = np.random.default_rng(3).normal(size=(600, 2)) * 3
    merged = density.merged_points(points_of(spark, data), COLUMNS, "CustomerID")
    placed = density._Density(merged, COLUMNS, 1.0, 5, merged.schema["_rep"].dataType, 20)
    placed.joint = joint
    found = [r.neighbors for r in placed.counts(placed.points).orderBy("_rep").collect()]
    assert found == (distances(data) <= 1.0).sum(axis=1).tolist()


def test_methods_run_side_by_side(spark):
    """All of them begin before one ends, and the first error ends the others' jobs."""
    together = threading.Barrier(3, timeout=60)
    found = analysis.side_by_side(
        spark, {n: lambda n=n: (together.wait(), spark.range(n).count())[1] for n in (1, 2, 3)}
    )
    assert found == {1: 1, 2: 2, 3: 3}
    assert analysis.side_by_side(spark, {}) == {}
    slow = spark.range(8).repartition(8).select(F.expr("reflect('java.lang.Thread', 'sleep', 60000L)"))

    def fails():
        raise ArithmeticError("no such fit")

    begun = time.monotonic()
    with pytest.raises(ArithmeticError):
        analysis.side_by_side(spark, {"slow": slow.collect, "broken": fails})
    assert time.monotonic() - begun < 40
