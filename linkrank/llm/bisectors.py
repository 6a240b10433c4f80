"""Clusters of vectors around centroids: a tournament of bisecting planes over whole numbers finds the nearest centroid."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkrank.llm.common import batch_of, task, Work

#: Below this magnitude of a component, 64 bits hold every product and sum of a test and of a squared distance.
SMALL = 2**27
LIMB = 60
ASSIGNED = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])
SUMS = pa.schema([("cluster", pa.int32()), ("dim", pa.int32()), ("limb", pa.int32()), ("value", pa.int64())])


def whole(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), as Python integers where 64 bits might not do."""
    if not x.size or np.abs(x).max() < SMALL / scale:
        return np.floor(scale * x).astype(np.int64)
    return np.frompyfunc(lambda v: math.floor(scale * v) if abs(v) < 1e300 else scale * int(v), 1, 1)(x)


def fitting(rows: list[list[int]], dim: int) -> np.ndarray:
    """Centroids as an array, of Python integers where a component isn't small."""
    small = all(-SMALL < v < SMALL for r in rows for v in r)
    return np.array(rows, np.int64 if small else object).reshape(len(rows), dim)


class Bisectors:
    """For each pair of centroids the plane between them: ``normal * x > threshold`` where x is nearer to the second."""

    def __init__(self, centroids: np.ndarray):
        squares = (centroids * centroids).sum(1)
        self.centroids = centroids
        self.normals = 2 * (centroids[None] - centroids[:, None])
        self.thresholds = squares[None] - squares[:, None]

    def nearest(self, x: np.ndarray) -> np.ndarray:
        """Numbers of the nearest centroids: each test eliminates one, and on the plane itself the larger number loses."""
        best = np.zeros(len(x), np.int64)
        for k in range(1, len(self.centroids)):
            side = (self.normals[best, k] * x).sum(1) - self.thresholds[best, k]
            best[(side > 0).astype(bool)] = k
        return best

    def distances(self, x: np.ndarray, best: np.ndarray) -> np.ndarray:
        apart = x - self.centroids[best]
        return (apart * apart).sum(1)


def _vectors(column: pa.Array, dim: int, scale: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return whole(values.astype(np.float64).reshape(-1, dim), scale)


def limbs(value: int) -> Iterator[tuple[int, int]]:
    """A whole number in pieces of 60 bits, the last one with the sign, so that any sum can be added up in 64 and 128 bits."""
    k = 0
    while not -(2**62) <= value < 2**62:
        yield k, value & ((1 << LIMB) - 1)
        value, k = value >> LIMB, k + 1
    yield k, value


def _sums(batches: Iterator[pa.RecordBatch], planes: Bisectors, dim: int, scale: int) -> Iterator[pa.RecordBatch]:
    """Sum and count of each centroid's vectors in one task; dim -1 has the count."""
    k = len(planes.centroids)
    count, total = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
    for batch in batches:
        x = _vectors(batch.column(0), dim, scale)
        best = planes.nearest(x)
        count += np.bincount(best, minlength=k)
        added = [x[best == c].sum(0) for c in range(k)]
        total = total + np.array(added, total.dtype if x.dtype != object else object).reshape(k, dim)
    rows = [(c, -1, 0, int(count[c])) for c in range(k) if count[c]]
    rows += [(c, d, p, v) for c in range(k) if count[c] for d in range(dim) for p, v in limbs(int(total[c, d]))]
    yield batch_of(SUMS, zip(*rows, strict=True) if rows else [[]] * 4)


def _assign(batches: Iterator[pa.RecordBatch], planes: Bisectors, dim: int, scale: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = _vectors(batch.column(0), dim, scale)
        best = planes.nearest(x)
        far = [int(v) if v < 2**63 else None for v in planes.distances(x, best)]
        yield batch_of(ASSIGNED, [batch.column(1), best.astype(np.int32), far])


def finite(vector: Column) -> Column:
    """Whether a vector has neither nulls nor components that are not finite."""
    infinite = F.lit(float("inf")).cast("double")
    return F.forall(vector, lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != infinite), F.lit(False)))


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024, seed: int = 3, id: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, list[list[int]]]:
    """``(vec_id, cluster, distance)`` for each vector kept, and the final centroids.

    Kept are vectors of exactly ``dim`` components, none null or not finite; a component x becomes floor(scale * x). The first
    centroids are the ``k`` vectors whose text ``seed:id`` has the smallest SHA-256 (null ids last, equal ids by vector). Each round
    assigns all vectors and moves every centroid that has some to the floor of their mean; one without any stays. Then they are
    assigned once more. distance is the squared distance, null beyond 64 bits. Repeated rows stay, a null id stays null, fewer than
    ``k`` vectors give as many centroids, and no vector gives no row. Other columns are not looked at.

    Assigning is a pass over one stored table. A task hands on one sum for each centroid and component, whatever the size of a cluster,
    and of these sums, added up by Spark, ``k * dim`` reach the driver. All numbers are whole, so the order of additions is of no
    account and every rerun agrees.
    """
    work = Work(vectors.sparkSession, "bisectors")
    kept = vectors.select(F.col(vector).alias("vector"), F.col(id).cast("long").alias("vec_id")).where((F.size("vector") == dim) & finite(F.col("vector")))
    kept = work.store(kept, "vectors")
    by_hash = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).asc_nulls_last()
    first = kept.orderBy(by_hash, "vector").limit(k).select("vector").collect()
    if not first:
        return vectors.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long"), []
    centroids = [list(map(int, r)) for r in whole(np.array([r["vector"] for r in first], np.float64), scale)]
    for _ in range(rounds):
        run = task(_sums, planes=Bisectors(fitting(centroids, dim)), dim=dim, scale=scale)
        sums = kept.select("vector").mapInArrow(run, "cluster int, dim int, limb int, value long")
        rows = sums.groupBy("cluster", "dim", "limb").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
        count = {r["cluster"]: int(r["value"]) for r in rows if r["dim"] < 0}
        total = {(c, d): 0 for c in count for d in range(dim)}
        for r in rows:
            if r["dim"] >= 0:
                total[r["cluster"], r["dim"]] += int(r["value"]) << (LIMB * r["limb"])
        centroids = [[total[c, d] // count[c] for d in range(dim)] if c in count else old for c, old in enumerate(centroids)]
    run = task(_assign, planes=Bisectors(fitting(centroids, dim)), dim=dim, scale=scale)
    return kept.select("vector", "vec_id").mapInArrow(run, "vec_id long, cluster int, distance long"), centroids


def with_inertia(assigned: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Adds ``cluster_inertia`` and ``inertia``, the distances summed over the cluster and over all, null beyond 64 bits, and the SHA-256 of
    the centroid's components as text. One row for each centroid is broadcast."""
    work = Work(assigned.sparkSession, "inertia")
    assigned = work.store(assigned, "assigned")
    known = F.when(F.count("distance") == F.count(F.lit(1)), F.sum(F.col("distance").cast("decimal(38,0)")))
    sums = {r["cluster"]: r["sum"] for r in assigned.groupBy("cluster").agg(known.alias("sum")).collect()}

    def bounded(value):
        return None if value is None or value >= 2**63 else int(value)

    all_ = bounded(None if None in sums.values() else sum(sums.values()))
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    rows = [(c, bounded(s), all_, digest[c]) for c, s in sums.items()]
    named = assigned.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
