import numpy as np
import pandas as pd
import pytest

from clientele.llm import embeddings

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def slow(rows, threshold=0.93):
    """(id, links, component) by comparing all pairs."""
    fit = []
    for k, (i, v, label) in enumerate(rows):
        ok = i is not None and label is not None and v and all(
            c is not None and np.isfinite(c) for c in v) and any(v)
        fit.append(np.array(v) / np.linalg.norm(v) if ok else None)
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if fit[a] is not None and fit[b] is not None and rows[a][2] == rows[b][2] and (
                len(fit[a]) == len(fit[b]) and fit[a] @ fit[b] >= threshold
            ):
                links[a] += 1
                links[b] += 1
                parent[root(a)] = root(b)
    least = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            least[root(k)] = min(least.get(root(k), r[0]), r[0])
    return sorted((str(r[0]), links[k], str(least.get(root(k)))) for k, r in enumerate(rows))


def found(df, **more):
    got = embeddings.near_duplicates(df, **more).collect()
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)
    return sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got)


def test_the_small_table_agrees_with_all_pairs(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, list(map(float, r.embedding)), r.label) for r in df.collect()]
    assert found(df) == slow(rows)


def clusters(n, size, noise, seed, d=24):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(n):
        centre = rng.standard_normal(d)
        for _ in range(size):
            rows.append((len(rows), (centre + noise * rng.standard_normal(d)).tolist(), c % 2))
    return rows


@pytest.mark.parametrize("noise", [0.12, 0.2])
def test_pairs_around_the_threshold_through_many_leaves(spark, monkeypatch, noise):
    monkeypatch.setattr(embeddings, "LEAF_ROWS", 60)
    monkeypatch.setattr(embeddings, "SAMPLE", 100)
    monkeypatch.setattr(embeddings, "LONG_LEAF", 100)
    rows = clusters(60, 20, noise, 3) + [(5000 + i, v, label) for i, (_, v, label) in enumerate(clusters(1, 300, 0.05, 8))]
    want, got = slow(rows), found(spark.createDataFrame(rows, SCHEMA).repartition(4))
    links = {w[0]: w[1] for w in want}
    assert all(g[1] <= links[g[0]] for g in got)
    assert sum(g[1] for g in got) >= 0.98 * sum(w[1] for w in want)


def test_nulls_zeros_copies_and_other_dimensions(spark):
    nan, inf = float("nan"), float("inf")
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 1), (2, v, 1), (2, v, 1), (3, [2.0, 4.0, 6.0], 1), (4, v, 2), (5, v, None),
            (6, None, 1), (7, [], 1), (8, [0.0, 0.0, 0.0], 1), (9, [nan, 1.0, 2.0], 1),
            (10, [inf, 1.0, 2.0], 1), (11, [None, 1.0, 2.0], 1), (None, v, 1), (12, [1.0, 2.0], 1),
            (13, [-1.0, -2.0, -3.0], 1), (14, [1e200, 2e200, 3e200], 1), (15, [1.0, 2.0, 0.0], 1)]
    got = found(spark.createDataFrame(rows, SCHEMA))
    rows[15] = (14, v, 1)
    assert got == slow(rows)
    assert found(spark.createDataFrame([], SCHEMA)) == []


def group(centre, size, cosine, rng):
    """Vectors around ``centre`` whose pairs have about the given cosine."""
    noise = rng.standard_normal((size, len(centre)))
    noise /= np.linalg.norm(noise, axis=1)[:, None]
    noise -= (noise @ centre)[:, None] * centre
    return np.sqrt(cosine) * centre + np.sqrt(1 - cosine) * noise


def test_recall_does_not_fall_in_large_groups_of_near_copies(spark):
    size = 5000
    rng = np.random.default_rng(size)
    unit = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)
    groups = [unit(group(unit(rng.standard_normal(64)), size, c, rng)) for c in (0.93, 0.95, 0.97)]
    alone = unit(rng.standard_normal((10_000, 64)))
    rows = np.concatenate([*groups, alone])
    place = rng.permutation(len(rows))
    df = spark.createDataFrame(pd.DataFrame({
        "vec_id": np.arange(len(rows)), "embedding": rows[place].tolist(), "label": 1,
    }), SCHEMA)
    got = embeddings.near_duplicates(df).toPandas().set_index("vec_id")["n_links"]
    found = np.empty(len(rows), dtype=np.int64)
    found[place] = got.loc[np.arange(len(rows))].to_numpy()
    for k, own in enumerate(groups):
        true = np.concatenate([(own[i:i + 1000] @ own.T >= 0.93).sum(axis=1) for i in range(0, size, 1000)]) - 1
        part = found[k * size:(k + 1) * size]
        assert (part <= true).all()
        assert part.sum() >= 0.9 * true.sum()
