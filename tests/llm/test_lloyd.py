import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from clientele.llm import lloyd

VECTORS = "vec_id bigint, embedding array<double>, label int"


def slow_lloyd(rows, components, clusters=8, rounds=10):
    kept = [
        (name, [math.floor(1024 * x) for x in v]) for name, v, *_ in rows
        if v is not None and len(v) == components
        and all(x is not None and math.isfinite(x) for x in v)
    ]
    digest = lambda r: hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (digest(r), r[1]))[:clusters]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c)), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for i in range(len(centroids)):
            members = [v for (_, v), c in zip(kept, own) if c == i]
            if members:
                centroids[i] = [sum(x) // len(members) for x in zip(*members)]
    found = [(name, *nearest(v)[::-1]) for name, v in kept]
    return sorted(map(str, found)), centroids


def rows_of(df):
    return sorted(str((r.vec_id, r.cluster, r.distance)) for r in df.collect())


@pytest.fixture(scope="module")
def odd_vectors():
    rng = random.Random(9)
    one = lambda: [rng.gauss(0, 1) for _ in range(6)]
    rows = [(i, one(), i % 3) for i in range(200)]
    hot = one()
    rows += [(500, hot, 1)] * 60 + [(i, hot, 1) for i in range(600, 640)]
    rows += [(None, one(), None), (None, one(), 2), (700, None, 1), (701, one()[:5], 1),
             (702, [*one()[:5], None], 1), (703, [*one()[:5], math.nan], 1), (705, [], 1),
             (704, [*one()[:5], math.inf], 1), (706, [0.0] * 6, 1), (707, [-0.0] * 6, 1)]
    return rows


@pytest.mark.parametrize("chunk_rows, columns", [(4_096, 16), (7, 4), (50, 1)])
def test_the_iterations_against_brute_force(spark, monkeypatch, odd_vectors, chunk_rows, columns):
    monkeypatch.setattr(lloyd, "SHARD_COLUMNS", columns)
    monkeypatch.setattr(lloyd, "shards", lambda n, c=columns: [
        slice(at, min(at + c, n)) for at in range(0, n, c)
    ])
    df = spark.createDataFrame(odd_vectors, VECTORS).repartition(5)
    for name in ("id", "cells", "chunk", "shard", "cluster", "distance", "gap"):
        df = df.withColumn(name, F.lit(None).cast("string"))
    found, centroids = lloyd.cluster_vectors(df, components=6, chunk_rows=chunk_rows)
    want, best = slow_lloyd(odd_vectors, 6)
    assert centroids.tolist() == best
    assert rows_of(found) == want
    told = lloyd.with_inertia(found, centroids).collect()
    total = sum(r.distance for r in told)
    for r in told:
        assert r.inertia == total
        assert r.cluster_inertia == sum(x.distance for x in told if x.cluster == r.cluster)
        text = ",".join(map(str, best[r.cluster]))
        assert r.centroid_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_few_and_no_vectors(spark, odd_vectors):
    three = odd_vectors[:3]
    found, centroids = lloyd.cluster_vectors(spark.createDataFrame(three, VECTORS), components=6)
    assert len(centroids) == 3 and rows_of(found) == slow_lloyd(three, 6)[0]
    none = spark.createDataFrame(odd_vectors[-8:-6], VECTORS)
    found = lloyd.with_inertia(*lloyd.cluster_vectors(none, components=6))
    assert found.count() == 0 and found.columns[-1] == "centroid_sha256"


def test_an_empty_cluster_keeps_its_centroid(spark):
    """Equal vectors: all go to the first of eight equal centroids."""
    rows = [(i, [1.0, 2.0], 0) for i in range(20)]
    found, centroids = lloyd.cluster_vectors(spark.createDataFrame(rows, VECTORS), components=2)
    assert {r.cluster for r in found.collect()} == {0}
    assert centroids.tolist() == [[1024, 2048]] * 8


def test_far_components_are_held_at_the_bound(spark):
    rows = [(0, [1e300, -1e300], 0), (1, [0.5, 0.25], 0)]
    found, centroids = lloyd.cluster_vectors(
        spark.createDataFrame(rows, VECTORS), components=2, clusters=1, rounds=1
    )
    assert found.count() == 2 and np.abs(centroids).max() <= lloyd.BOUND


def test_the_query_against_sql(spark, small):
    got = lloyd.op13_lloyd(spark, small).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{small}/embeddings.parquet'")
    assert sorted(map(tuple, got)) == sorted(con.execute(lloyd.SQL).fetchall())
