"""Centroid clustering with dimension-sharded Lloyd iterations, exact in integers.

Vectors become whole numbers, floor(scale * x) of each component. The table is cut twice: by rows
into chunks, by columns into shards. A block is one chunk of one shard, and a shard knows only its
own slice of the centroids. In a round, block tasks compute the squared distances of their rows
within the slice; the partial distances of a chunk are added up over its shards, which are exact
because they are integers, and the nearest centroid is taken, the smaller number on a tie. The
numbers, a few bytes a row, go back to the blocks of the chunk, each shard adds up its columns by
cluster, and floor(sum / count) is the shard's new slice. An empty cluster keeps its centroid.

Blocks and the numbers of each round are stored in the shared folder, so a lost executor costs
only its tasks. The driver holds the centroids alone: clusters x components.

Nulls and ties: vectors that are null, of another length, or hold null or non-finite components
are left out. Components beyond +-2^26 after scaling (65,536 in the query) are held at that bound,
so that all sums fit into 64 bits. Repeated rows and rows without an id are rows of their own; the
first centroids of equal ids come in the order of their components. Fewer vectors than clusters
give as many clusters as vectors, none gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.llm.common import store

COMPONENTS = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
SALT = 3
#: Columns of a shard and rows of a chunk, at most.
SHARD_COLUMNS = 16
CHUNK_ROWS = 4_096
BOUND = 1 << 26
#: Chunks that one task of a shard works on.
TASK_CHUNKS = 8

_BLOCKS = "chunk bigint, shard int, ids binary, missing binary, cells binary"
_NAMES = ["chunk", "shard", "ids", "missing", "cells"]


def kept_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
    components: int = COMPONENTS, scale: int = SCALE,
) -> DataFrame:
    """(id, cells): the usable vectors as whole numbers."""
    vector = F.col(vector_col)
    usable = (F.size(vector) == components) & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    whole = F.transform(
        F.when(usable, vector), lambda x: F.floor(F.greatest(
            F.least(x.cast("double") * scale, F.lit(float(BOUND))), F.lit(float(-BOUND))
        )).cast("int")
    )
    return vectors.select(
        F.col(id_col).cast("bigint").alias("id"), whole.alias("cells")
    ).where(F.coalesce(usable, F.lit(False)))


def first_centroids(kept: DataFrame, clusters: int, salt: int) -> np.ndarray:
    """The vectors with the least digests of ``salt:id``."""
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    rows = kept.orderBy(digest, "cells").limit(clusters).collect()
    return np.array([r.cells for r in rows], dtype=np.int64)


def shards(components: int, columns: int = SHARD_COLUMNS) -> list[slice]:
    return [slice(at, min(at + columns, components)) for at in range(0, components, columns)]


def _cut(batches: Iterator[pa.RecordBatch], slices: list[slice], chunk_rows: int):
    """Blocks of each chunk, one for each shard; the first one carries the ids."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 33
    for batch in batches:
        ids = batch.column("id")
        cells = batch.column("cells").flatten().to_numpy().reshape(batch.num_rows, -1)
        missing = np.asarray(ids.is_null())
        ids = ids.fill_null(0).to_numpy()
        for at in range(0, len(ids), chunk_rows):
            rows = slice(at, at + chunk_rows)
            yield pa.RecordBatch.from_arrays([
                pa.array([number] * len(slices), pa.int64()),
                pa.array(range(len(slices)), pa.int32()),
                pa.array([ids[rows].tobytes()] + [None] * (len(slices) - 1), pa.binary()),
                pa.array([missing[rows].tobytes()] + [None] * (len(slices) - 1), pa.binary()),
                pa.array([np.ascontiguousarray(cells[rows, s], dtype="<i4").tobytes()
                          for s in slices], pa.binary()),
            ], _NAMES)
            number += 1


def column_blocks(kept: DataFrame, slices: list[slice], chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """The stored blocks, dealt so that a task holds chunks of one shard, or of two at a seam."""
    spark = kept.sparkSession
    cut = store(kept.mapInArrow(lambda b: _cut(b, slices, chunk_rows), _BLOCKS), "chunks")
    blocks = cut.count()
    tasks = max(min(spark.sparkContext.defaultParallelism, blocks), -(-blocks // TASK_CHUNKS))
    return store(cut.repartitionByRange(max(tasks, 1), "shard", "chunk"), "blocks")


def _block_cells(data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, dtype="<i4").reshape(-1, width).astype(np.int64)


def partial_distances(cells: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances (rows x clusters) within one slice of the columns."""
    gaps = np.empty((len(cells), len(centroids)), dtype=np.int64)
    for cluster, centroid in enumerate(centroids):
        apart = cells - centroid
        gaps[:, cluster] = np.einsum("ij,ij->i", apart, apart)
    return gaps


def _partials(batches, sent, slices):
    for batch in batches:
        found = [
            partial_distances(
                _block_cells(data, slices[shard].stop - slices[shard].start),
                sent.value[:, slices[shard]],
            ).tobytes()
            for shard, data in zip(
                batch.column("shard").to_pylist(), batch.column("cells").to_pylist(), strict=True
            )
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("chunk"), pa.array(found, pa.binary())], ["chunk", "gaps"]
        )


def _nearest(clusters: int):
    """Adds the partial distances of a chunk and takes each row's least one."""

    def reduce(table: pa.Table) -> pa.Table:
        total = sum(
            np.frombuffer(part, dtype=np.int64) for part in table.column("gaps").to_pylist()
        ).reshape(-1, clusters)
        label = total.argmin(axis=1)
        gap = total[np.arange(len(total)), label]
        return pa.table({
            "chunk": table.column("chunk").slice(0, 1),
            "label": pa.array([label.astype("<i4").tobytes()], pa.binary()),
            "gap": pa.array([gap.astype("<i8").tobytes()], pa.binary()),
        })

    return reduce


def assign_blocks(blocks: DataFrame, centroids: np.ndarray, slices: list[slice]) -> DataFrame:
    """(chunk, label, gap), stored: the nearest centroid of each row of each chunk."""
    sent = blocks.sparkSession.sparkContext.broadcast(centroids)
    partial = blocks.select("chunk", "shard", "cells").mapInArrow(
        lambda b: _partials(b, sent, slices), "chunk bigint, gaps binary"
    )
    labels = partial.groupBy("chunk").applyInArrow(
        _nearest(len(centroids)), "chunk bigint, label binary, gap binary"
    )
    return store(labels, "nearest")


def _slice_sums(batches, slices, clusters: int):
    """Counts and column sums of each cluster, one array a shard and partition."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("shard", "cells", "label"))
        for shard, data, label in zip(*columns, strict=True):
            width = slices[shard].stop - slices[shard].start
            cells = _block_cells(data, width)
            label = np.frombuffer(label, dtype="<i4")
            held = sums.setdefault(shard, np.zeros((clusters, 1 + width), dtype=np.int64))
            for cluster in np.unique(label):
                own = cells[label == cluster]
                held[cluster, 0] += len(own)
                held[cluster, 1:] += own.sum(axis=0)
    for shard, held in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array([held.tobytes()], pa.binary())],
            ["shard", "sums"],
        )


def moved_centroids(
    blocks: DataFrame, labels: DataFrame, centroids: np.ndarray, slices: list[slice]
) -> np.ndarray:
    """The centroids after each shard took the floor of the means of its own columns."""
    clusters = len(centroids)
    joined = blocks.select("chunk", "shard", "cells").join(labels.select("chunk", "label"), "chunk")
    parts = joined.select("shard", "cells", "label").mapInArrow(
        lambda b: _slice_sums(b, slices, clusters), "shard int, sums binary"
    )

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(s, dtype=np.int64) for s in table.column("sums").to_pylist())
        return pa.table({
            "shard": table.column("shard").slice(0, 1),
            "sums": pa.array([total.tobytes()], pa.binary()),
        })

    moved = centroids.copy()
    for row in parts.groupBy("shard").applyInArrow(add, "shard int, sums binary").collect():
        total = np.frombuffer(row.sums, dtype=np.int64).reshape(clusters, -1)
        filled = np.flatnonzero(total[:, 0])
        moved[filled, slices[row.shard]] = total[filled, 1:] // total[filled, :1]
    return moved


def _rows(batches):
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("ids", "missing", "label", "gap"))
        for ids, missing, label, gap in zip(*columns, strict=True):
            ids = pa.array(
                np.frombuffer(ids, dtype=np.int64), mask=np.frombuffer(missing, dtype=bool)
            )
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.frombuffer(label, dtype="<i4")),
                 pa.array(np.frombuffer(gap, dtype="<i8"))],
                ["vec_id", "cluster", "distance"],
            )


def cluster_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
    components: int = COMPONENTS, clusters: int = CLUSTERS, rounds: int = ROUNDS,
    scale: int = SCALE, salt: int = SALT, chunk_rows: int = CHUNK_ROWS,
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every usable vector, stored, and the last centroids."""
    spark = vectors.sparkSession
    result = "vec_id bigint, cluster int, distance bigint"
    kept = kept_vectors(vectors, id_col, vector_col, components, scale)
    centroids = first_centroids(kept, clusters, salt)
    if not len(centroids):
        return spark.createDataFrame([], result), centroids
    slices = shards(components)
    blocks = column_blocks(kept, slices, chunk_rows)
    for _ in range(rounds):
        labels = assign_blocks(blocks, centroids, slices)
        moved = moved_centroids(blocks, labels, centroids, slices)
        if (moved == centroids).all():
            break
        centroids = moved
    # Centroids that stand still give the same numbers in every further round.
    labels = assign_blocks(blocks, centroids, slices)
    named = blocks.where("shard = 0").select("chunk", "ids", "missing").join(labels, "chunk")
    return store(named.drop("chunk").mapInArrow(_rows, result), "clusters"), centroids


def centroid_digest(centroid: Sequence[int]) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in centroid).encode()).hexdigest()


def with_inertia(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``found`` with the sums of distances of its cluster and of all, and the centroid's digest."""
    spark = found.sparkSession
    sums = {
        r.cluster: int(r.s) for r in found.groupBy("cluster").agg(
            F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")
        ).collect()
    }
    total = sum(sums.values())
    rows = [
        (i, sums[i], total, centroid_digest(c)) for i, c in enumerate(centroids) if i in sums
    ]
    told = spark.createDataFrame(
        rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    )
    return found.join(F.broadcast(told), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def op13_lloyd(spark: SparkSession, folder: str) -> DataFrame:
    vectors = spark.read.parquet(f"{folder.rstrip('/')}/embeddings.parquet")
    return with_inertia(*cluster_vectors(vectors))


def _sql() -> str:
    steps = [f"""
WITH usable AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id,
    list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {COMPONENTS} AND len(list_filter(embedding,
    lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
),
cells AS MATERIALIZED (
  SELECT r, unnest(v) AS x, unnest(range({COMPONENTS})) AS j FROM usable
),
c0 AS MATERIALIZED (
  SELECT c, unnest(v) AS y, unnest(range({COMPONENTS})) AS j FROM (
    SELECT v, row_number() OVER (ORDER BY sha256('{SALT}:' || vec_id), v) - 1 AS c FROM usable
  ) WHERE c < {CLUSTERS}
)"""]
    for i in range(ROUNDS + 1):
        steps.append(f"""
g{i} AS MATERIALIZED (
  SELECT r, min(struct_pack(d := d, c := c)) AS best FROM (
    SELECT r, c, sum((x - y) * (x - y)) AS d FROM cells JOIN c{i} USING (j) GROUP BY r, c
  ) GROUP BY r
)""")
        if i < ROUNDS:
            steps.append(f"""
c{i + 1} AS MATERIALIZED (
  SELECT c, j, coalesce(m, y) AS y FROM c{i} LEFT JOIN (
    SELECT best.c AS c, j, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*)
      AS BIGINT) AS m
    FROM cells JOIN g{i} USING (r) GROUP BY best.c, j
  ) USING (c, j)
)""")
    last = f"g{ROUNDS}"
    return ",".join(steps) + f"""
SELECT vec_id, CAST(best.c AS INTEGER) AS cluster, CAST(best.d AS BIGINT) AS distance,
  CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(best.d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM {last} JOIN usable USING (r) JOIN (
  SELECT c, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY j)) AS centroid_sha256
  FROM c{ROUNDS} GROUP BY c
) h ON h.c = best.c
"""


SQL = _sql()
