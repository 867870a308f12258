"""Centroid clustering in whole numbers, pruned by Ptolemaic pivots.

The vectors that start as centroids stay behind as fixed pivots, and every vector's
distances to them are cached in a table once. For a vector x, a centroid c and a pair of
pivots p, q, Ptolemy's inequality gives

    d(x, c) >= |d(x, p) d(c, q) - d(x, q) d(c, p)| / d(p, q).

A centroid's pairs are its own pivot with the next few. Bounds are rounded down by more
than the floating-point error; a centroid whose bound lies beyond the distance to a first
guess (the centroid of the nearest pivot) is skipped, the others are compared exactly in
64-bit integers. Only centroids, at most ``k`` sums a task and ``k`` sums a round leave the
tasks, so a cluster that holds most rows is no burden.

Defined results: vectors with another number of components, or with null or non-finite
ones, are left out. Components are held within +-2^27 after scaling (x within two
million), so that distances fit 64 bits; sums of distances beyond a long are the largest
long. Ids may repeat or be null (each row counts; rows without an id start as centroids
last). Equal hashes are started in the order of the vectors. With fewer vectors than ``k``
there are as many centroids; without any the result is empty. Further columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, batch_of, pick

#: Pivot pairs a centroid.
PAIRS = 4
#: Relative error that bounds are lowered by; that of the few roundings in one is below 1e-15.
SLACK = 1e-13
#: Largest component in magnitude.
LARGEST = 1 << 27


def whole_vectors(df: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = 64, scale: int = 64) -> DataFrame:
    """``id, v`` of the vectors with ``dims`` finite components, ``v`` = floor(scale * x)."""
    src = pick(df, id=id_col, e=vector_col).where(F.size("e") == dims)
    x = lambda c: c.cast("double")
    finite = F.forall("e", lambda c: F.coalesce(F.abs(x(c)) < F.lit(float("inf")), F.lit(False)))
    held = lambda c: F.least(F.greatest(F.floor(F.least(F.greatest(x(c) * scale, F.lit(-4.0 * LARGEST)), F.lit(4.0 * LARGEST))), F.lit(-LARGEST)), F.lit(LARGEST))
    return src.where(finite).select("id", F.transform("e", lambda c: held(c).cast("bigint")).alias("v"))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def exact(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of rows to one point (or to a row each) in whole numbers."""
    d = v - c
    return np.einsum("ij,ij->i", d, d)


class Pruned:
    """Nearest centroids, with the bounds of fixed pivots in front of the exact comparison."""

    def __init__(self, pivots: np.ndarray, centroids: np.ndarray):
        self.centroids, k = centroids, len(pivots)
        far = np.sqrt(np.array([exact(pivots, p) for p in pivots], np.float64))  # pivot to pivot
        to = np.sqrt(np.array([exact(pivots, c) for c in centroids], np.float64))  # centroid to pivot
        own = np.arange(k)
        self.pairs = []
        for step in range(1, min(PAIRS, k - 1) + 1):
            other = (own + step) % k
            between = far[own, other]
            # equal pivots bound nothing
            self.pairs.append((other, to[own, other], to[own, own], np.where(between > 0, between, np.inf)))
        self.compared = 0

    def bounds(self, near: np.ndarray) -> np.ndarray:
        """Lower bounds of all distances from the cached pivot distances (rows x pivots)."""
        low = np.zeros_like(near)
        for other, to_other, to_own, between in self.pairs:
            a, b = near * to_other, near[:, other] * to_own
            np.maximum(low, (np.abs(a - b) - SLACK * (a + b)) / between, out=low)
        return low * (1 - SLACK)

    def nearest(self, v: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of the nearest centroid of each row (the smallest among equals) and the squared distance."""
        guess = near.argmin(axis=1)
        best = exact(v, self.centroids[guess])
        survives = self.bounds(near) <= (np.sqrt(best.astype(np.float64)) * (1 + SLACK))[:, None]
        found = guess.copy()
        for c, centroid in enumerate(self.centroids):
            rows = np.flatnonzero(survives[:, c] & (guess != c))
            self.compared += len(rows)
            d = exact(v[rows], centroid)
            closer = (d < best[rows]) | ((d == best[rows]) & (c < found[rows]))
            best[rows[closer]], found[rows[closer]] = d[closer], c
        return found, best


def cluster(df: DataFrame, scratch: Scratch, *, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = 64, scale: int = 64, k: int = 16, rounds: int = 3, seed: int = 1) -> DataFrame:
    """``id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every kept vector.

    Starts with the ``k`` vectors of smallest sha256 of ``seed:id``; each round assigns all
    vectors and moves every centroid that has some to the floor of their mean.
    """
    points = whole_vectors(df, id_col=id_col, vector_col=vector_col, dims=dims, scale=scale)
    kind = points.schema["id"].dataType.simpleString()
    drawn = points.withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256))
    start = [r["v"] for r in drawn.orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()]
    if not start:
        return df.sparkSession.createDataFrame([], f"id {kind}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string").withColumnRenamed("id", id_col)
    pivots = np.array(start, np.int64)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = matrix(batch.column("v"), dims)
            near = np.sqrt(np.array([exact(v, p) for p in pivots], np.float64)).T
            schema = pa.schema([("id", batch.column("id").type), ("v", pa.list_(pa.int64())), ("near", pa.list_(pa.float64()))])
            yield batch_of(schema, [batch.column("id"), batch.column("v"), list(near)])

    cached = scratch.table(points.mapInArrow(measure, f"id {kind}, v array<bigint>, near array<double>"), "pivots")
    centroids = pivots
    for _ in range(rounds):
        centroids = _moved(cached, pivots, centroids)
    found = scratch.table(_assigned(cached, pivots, centroids, kind), "clusters")
    return _reported(found, centroids).withColumnRenamed("id", id_col)


def _moved(cached: DataFrame, pivots: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round; a task gives one row of sums a cluster."""
    k, dims = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by, n, total = Pruned(pivots, centroids), np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            v = matrix(batch.column("v"), dims)
            to, _ = by.nearest(v, matrix(batch.column("near"), k))
            n += np.bincount(to, minlength=k)
            np.add.at(total, to, v)
        some = np.flatnonzero(n)
        schema = pa.schema([("c", pa.int32()), ("n", pa.int64()), ("s", pa.list_(pa.int64()))])
        yield batch_of(schema, [some, n[some], list(total[some])])

    parts = cached.select("v", "near").mapInArrow(sums, "c int, n bigint, s array<bigint>")
    rows = parts.groupBy("c").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("s")[i]) for i in range(dims)]).alias("s")).collect()  # k rows
    moved = centroids.copy()
    for r in rows:
        moved[r["c"]] = [s // r["n"] for s in r["s"]]
    return moved


def _assigned(cached: DataFrame, pivots: np.ndarray, centroids: np.ndarray, kind: str) -> DataFrame:
    k, dims = centroids.shape

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = Pruned(pivots, centroids)
        for batch in batches:
            to, distance = by.nearest(matrix(batch.column("v"), dims), matrix(batch.column("near"), k))
            yield batch_of(pa.schema([("id", batch.column("id").type), ("cluster", pa.int32()), ("distance", pa.int64())]), [batch.column("id"), to, distance])

    return cached.mapInArrow(assign, f"id {kind}, cluster int, distance bigint")


def _reported(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Sums of distances and the centroids' hashes beside every row; the joined side has a row a cluster."""
    longest = F.lit((1 << 63) - 1)
    held = lambda c: F.least(c, longest.cast("decimal(38,0)")).cast("bigint")
    sums = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(19,0)")).cast("decimal(38,0)").alias("s")).collect()}  # k rows
    whole = sum(sums.values())
    rows = [(c, s, whole, hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, s in sums.items()]
    side = found.sparkSession.createDataFrame(rows, "cluster int, s decimal(38,0), w decimal(38,0), centroid_sha256 string")
    side = side.select("cluster", held(F.col("s")).alias("cluster_inertia"), held(F.col("w")).alias("inertia"), "centroid_sha256")
    return found.join(F.broadcast(side), "cluster").select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
