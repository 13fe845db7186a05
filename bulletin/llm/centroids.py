"""Centroid clustering of integer vectors by bisector tournaments.

Vectors become integers, so every distance and every mean is exact. For centroids i < j the
bisecting plane has the integer normal cj - ci and the threshold |cj|^2 - |ci|^2: a vector v
is nearer to j exactly where 2 v (cj - ci) - (|cj|^2 - |ci|^2) is positive. A vector plays
the centroids in ascending order; each of the k - 1 linear sign tests eliminates a loser,
and zero, a tie, keeps the smaller number. Only the winner's distance is computed.

A round is one pass over the settled vectors. Tasks add up their own vectors per centroid,
so that k rows a task reach the only shuffle, whatever a cluster's share of the rows. The
driver holds k centroids, k(k - 1)/2 planes and the k * d sums: bounds set by parameters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bulletin.llm.common import settle

#: Largest component, in magnitude: differences, products and distances then fit 64 bits up to LIMIT_DIMS components.
LIMIT, LIMIT_DIMS = 1 << 25, 512
#: Planes take k * k * d numbers in every task.
LIMIT_PLANES = 1 << 24


def integer_vectors(vectors: DataFrame, dims: int = 64, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """`vec_id, v`: vectors of exactly `dims` components, none null or non-finite, as floor(scale * x) in doubles."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda c: F.coalesce(F.abs(c) < F.lit(float("inf")), F.lit(False)))
    whole = F.when((F.size(x) == dims) & finite, x)
    rows = vectors.select(F.col(id_col).alias("vec_id"), whole.alias("x")).filter("x IS NOT NULL")
    inside = F.forall("x", lambda c: F.abs(c * scale) < LIMIT)
    checked = F.when(inside, F.col("x")).otherwise(F.raise_error(F.lit(f"a component is {LIMIT} or more in magnitude, times {scale}")))
    return rows.select("vec_id", F.transform(checked, lambda c: F.floor(c * scale).cast("bigint")).alias("v"))


def planes(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normals [i, j] and thresholds [i, j] of the bisectors of all pairs i < j."""
    norms = (centroids * centroids).sum(1)
    normals = centroids[None, :, :] - centroids[:, None, :]
    return 2 * normals, norms[None, :] - norms[:, None]


def tournament(vectors: np.ndarray, normals: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """The nearest centroid of every vector, the smaller number where two are equally near."""
    best = np.zeros(len(vectors), np.int64)
    for rival in range(1, len(thresholds)):
        # Vectors with the same champion meet the same plane.
        for champion in np.unique(best):
            own = np.flatnonzero(best == champion)
            signs = vectors[own] @ normals[champion, rival] - thresholds[champion, rival]
            best[own[signs > 0]] = rival
    return best


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64, copy=False).reshape(-1, dims)


def _sums(centroids: list[list[int]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's vectors added up per centroid: `cluster, n, at, total`, k * d rows at most."""
    k, dims = len(centroids), len(centroids[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        normals, thresholds = planes(np.array(centroids, np.int64))
        n, total = np.zeros(k, np.int64), np.zeros((k, dims), object)
        for batch in batches:
            v = _matrix(batch.column("v"), dims)
            best = tournament(v, normals, thresholds)
            for c in np.unique(best):
                own = v[best == c]
                n[c] += len(own)
                total[c] += own.sum(0).astype(object)
        held = np.flatnonzero(n)
        columns = [
            pa.array(np.repeat(held, dims), pa.int32()), pa.array(np.repeat(n[held], dims), pa.int64()),
            pa.array(np.tile(np.arange(dims), len(held)), pa.int32()), pa.array([str(x) for x in total[held].ravel()], pa.string()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["cluster", "n", "at", "total"])

    return run


def _assigned(centroids: list[list[int]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`vec_id, cluster, distance` of every vector."""
    dims = len(centroids[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = np.array(centroids, np.int64)
        normals, thresholds = planes(points)
        for batch in batches:
            v = _matrix(batch.column("v"), dims)
            best = tournament(v, normals, thresholds)
            apart = v - points[best]
            columns = [batch.column("vec_id"), pa.array(best, pa.int32()), pa.array((apart * apart).sum(1), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance"])

    return run


def first_centroids(points: DataFrame, k: int) -> list[list[int]]:
    """The k vectors with the smallest SHA-256 of `1:<vec_id>`: each task hands on k at most."""
    lot = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    return [list(r.v) for r in points.select(lot.alias("lot"), "v").orderBy(F.col("lot").asc_nulls_last(), "v").limit(k).collect()]


def moved(points: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Every centroid at the exact floor of its vectors' means; an empty one stays."""
    parts = points.mapInArrow(_sums(centroids), "cluster int, n bigint, at int, total string")
    whole = F.sum(F.col("total").cast("decimal(38,0)"))
    sums = parts.groupBy("cluster", "at").agg(F.sum("n").alias("n"), whole.alias("total")).collect()
    out = [list(c) for c in centroids]
    for r in sums:
        out[r.cluster][r.at] = int(r.total) // int(r.n)
    return out


def _by_cluster(values: list, kind: str) -> Column:
    """A driver's value per cluster, looked up in a constant array."""
    array = F.split(F.lit(",".join(map(str, values))), ",")
    return F.element_at(array, F.col("cluster") + 1).cast(kind)


def cluster(
    vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """`vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256` of every kept vector.

    Vectors of another length, a null vector and one with a null, NaN or infinite component
    are left out. Fewer vectors than `k` give as many centroids; none gives no rows. Repeated
    rows each count and each return; where ids repeat or are null (last) the smaller vector
    starts first. Other columns are not read, so their names cannot clash. A component whose
    scaled magnitude reaches 2^25 fails the job with a message, since distances would leave
    64 bits. `centroid_sha256` hashes the components in decimal, joined by commas.
    """
    if dims > LIMIT_DIMS or k * k * dims > LIMIT_PLANES:
        raise ValueError(f"at most {LIMIT_DIMS} components and k * k * dims of {LIMIT_PLANES}")
    points = settle(integer_vectors(vectors, dims, scale, id_col, vector_col), "centroid-vectors")
    centroids = first_centroids(points, k)
    kind = dict(points.dtypes)["vec_id"]
    if not centroids:
        empty = "CAST(NULL AS INT) cluster, 0L distance, 0L cluster_inertia, 0L inertia, '' centroid_sha256"
        return points.filter("false").selectExpr("vec_id", *empty.split(", "))
    for _ in range(rounds):
        centroids = moved(points, centroids)
    said = settle(points.mapInArrow(_assigned(centroids), f"vec_id {kind}, cluster int, distance bigint"), "centroid-clusters")
    inertia = dict.fromkeys(range(len(centroids)), 0)
    inertia |= {r.cluster: r.inertia for r in said.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return said.select(
        "*",
        _by_cluster([inertia[c] for c in range(len(centroids))], "bigint").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("bigint").alias("inertia"),
        _by_cluster(hashes, "string").alias("centroid_sha256"),
    )
