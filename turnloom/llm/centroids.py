"""Centroid clustering over exact integers with an incremental distance matrix.

Vectors become integers.  Each keeps its exact dot products with all centroids in a written table; after a round only the components of a
centroid that changed are multiplied again and added, and the nearest centroid follows from ``|c|^2 - 2 c.x``.  What a round moves is one row
of exact sums a cluster and task.

Defined results: vectors that are null, of another length, or hold null or non-finite components are left out; vectors without an id are
clustered like others but become first centroids only after all with an id; rows that repeat are vectors of their own; with fewer vectors
than centroids there are as many centroids as vectors; ties go to the smaller number, and an empty cluster keeps its centroid; an empty
table gives an empty result; other columns, whatever their names, are not read.  A component beyond 2**26 is an error, because its distances
would not fit 64-bit integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.llm.storage import discard, materialize

LIMIT = 1 << 26
STATE = "vec_id bigint, x array<int>, dots array<bigint>, cluster int, distance bigint"


def integers(rows: DataFrame, scale: int, dims: int | None, id_col: str, vector_col: str) -> DataFrame:
    """Usable vectors as vec_id and x, the floor of each component times ``scale``."""
    v = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    usable = F.col("v").isNotNull() & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = rows.select(F.col(id_col).cast("bigint").alias("vec_id"), v.alias("v")).where(usable if dims is None else usable & (F.size("v") == dims))
    return kept.select("vec_id", F.transform("v", lambda c: F.floor(c * scale)).alias("x"))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """An Arrow column of equally long integer lists as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dims)


def _listed(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * width, width, dtype=np.int32)), pa.array(np.ascontiguousarray(values).reshape(-1), kind))


def stepped(rows: DataFrame, changes: np.ndarray, centroids: np.ndarray) -> DataFrame:
    """Add the products with ``changes`` (centroids x components) to the kept ones, and assign each vector to the nearest of ``centroids``."""
    k, dims = centroids.shape
    norms = (centroids * centroids).sum(axis=1)
    moved = [(c, np.flatnonzero(changes[c])) for c in range(k) if changes[c].any()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, dots = matrix(batch.column("x"), dims), matrix(batch.column("dots"), k)
            dots = dots.copy()
            for c, at in moved:
                dots[:, c] += x[:, at] @ changes[c, at]
            away = norms - 2 * dots
            nearest = away.argmin(axis=1)
            distance = away[np.arange(len(x)), nearest] + (x * x).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), _listed(x, pa.int32()), _listed(dots, pa.int64()), pa.array(nearest, pa.int32()), pa.array(distance, pa.int64())], names=["vec_id", "x", "dots", "cluster", "distance"])

    return rows.select("vec_id", "x", "dots").mapInArrow(run, STATE)


def cluster_sums(state: DataFrame, k: int, dims: int) -> list[tuple[int, list[int], int]]:
    """Number of vectors, sum of each component and sum of distances of each cluster: exact, and one row a cluster for the driver.

    Tasks add up in 64 bits what they hold, and Spark adds the tasks' rows as decimals.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total, away = np.zeros(k, np.int64), np.zeros((k, dims), np.int64), [0] * k
        for batch in batches:
            if batch.num_rows:
                x, cluster, distance = matrix(batch.column("x"), dims), batch.column("cluster").to_numpy(), batch.column("distance").to_numpy()
                for c in np.unique(cluster).tolist():
                    own = cluster == c
                    count[c] += own.sum()
                    total[c] += x[own].sum(axis=0)
                    away[c] += int(distance[own].sum(dtype=object))
        some = np.flatnonzero(count).tolist()
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(count[some]), pa.array([str(away[c]) for c in some]), pa.array([list(map(str, total[c].tolist())) for c in some], pa.list_(pa.string()))], names=["cluster", "n", "away", "total"])

    parts = state.select("x", "cluster", "distance").mapInArrow(run, "cluster int, n bigint, away string, total array<string>")
    exact = "decimal(38,0)"
    sums = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.sum(F.col("away").cast(exact)).alias("away"), *[F.sum(F.col("total")[j].cast(exact)).alias(f"s{j}") for j in range(dims)])
    out = [(0, [0] * dims, 0)] * k
    for row in sums.collect():  # at most k rows
        out[row[0]] = (row[1], [int(v) for v in row[3:]], int(row[2]))
    return out


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors whose ids have the least SHA-256 of ``seed:id``, in that order; equal ones by their components."""
    keyed = vectors.withColumn("key", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256))
    return np.array([r["x"] for r in keyed.orderBy(F.col("key").asc_nulls_last(), "x").limit(k).collect()], dtype=np.int64)  # k rows


def cluster(rows: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Return vec_id, cluster, distance (squared), cluster_inertia, inertia and centroid_sha256 of every usable vector.

    The driver holds the centroids, ``k`` times ``dims`` numbers.
    """
    spark = rows.sparkSession
    vectors = integers(rows, scale, dims, id_col, vector_col)
    wide = F.exists("x", lambda c: F.abs(c) > LIMIT)
    vectors = vectors.select("vec_id", F.when(wide, F.raise_error(F.lit(f"a component beyond {LIMIT} after scaling"))).otherwise(F.col("x")).cast("array<int>").alias("x"))
    vectors = vectors.withColumn("dots", F.array_repeat(F.lit(0).cast("bigint"), k))
    state = materialize(vectors, "cluster-vectors")
    centroids = first_centroids(state, k, seed)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    k = len(centroids)
    state_rows = state.withColumn("dots", F.slice("dots", 1, k))
    changes = centroids
    for turn in range(rounds + 1):
        before, state = state, materialize(stepped(state_rows, changes, centroids), "cluster-state")
        discard(before)
        state_rows = state
        sums = cluster_sums(state, k, dims)
        if turn < rounds:
            after = np.array([[s // n for s in total] if n else old for (n, total, _), old in zip(sums, centroids.tolist(), strict=True)], dtype=np.int64)
            changes, centroids = after - centroids, after
    whole = sum(away for _, _, away in sums)
    known = [(c, sums[c][2], hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c in range(k)]
    inertia, digest = (F.element_at(F.array(*[F.lit(r[j]) for r in known]), F.col("cluster") + 1) for j in (1, 2))
    return state.select("vec_id", "cluster", "distance", inertia.cast("bigint").alias("cluster_inertia"), F.lit(whole).cast("bigint").alias("inertia"), digest.alias("centroid_sha256"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster all embeddings around 16 centroids in three rounds."""
    return cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _oracle(k: int = 16, rounds: int = 3) -> str:
    parts = [
        "kept AS (SELECT vec_id, embedding FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = 64)",
        "e AS (SELECT vec_id, unnest(range(64)) AS j, unnest(list_transform(embedding, lambda c: CAST(floor(64 * CAST(c AS DOUBLE)) AS BIGINT))) AS x FROM kept)",
        f"top AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c FROM kept QUALIFY c < {k})",
        "c0 AS (SELECT c, j, x FROM top JOIN e USING (vec_id))",
    ]
    for t in range(rounds + 1):
        parts.append(f"d{t} AS (SELECT vec_id, c, CAST(sum((e.x - q.x) * (e.x - q.x)) AS BIGINT) AS distance FROM e JOIN c{t} q USING (j) GROUP BY vec_id, c)")
        parts.append(f"a{t} AS (SELECT vec_id, min(c) AS c, distance FROM d{t} JOIN (SELECT vec_id, min(distance) AS distance FROM d{t} GROUP BY vec_id) USING (vec_id, distance) GROUP BY vec_id, distance)")
        parts.append(f"s{t} AS (SELECT c, j, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM e JOIN a{t} USING (vec_id) GROUP BY c, j)")
        parts.append(f"c{t + 1} AS (SELECT q.c, q.j, CASE WHEN s.n IS NULL THEN q.x ELSE (s.s - ((s.s % s.n) + s.n) % s.n) // s.n END AS x FROM c{t} q LEFT JOIN s{t} s ON s.c = q.c AND s.j = q.j)")
    parts.append(f"h AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY j)) AS centroid_sha256 FROM c{rounds} GROUP BY c)")
    return f"WITH {', '.join(parts)} SELECT vec_id, CAST(c AS INT) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256 FROM a{rounds} JOIN h USING (c)"


ORACLE = _oracle()
