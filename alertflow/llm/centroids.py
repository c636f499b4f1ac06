"""Centroid clustering: Lloyd rounds whose assignment is a bisector tournament.

For each pair of centroids a < b the bisecting hyperplane is precomputed in
integers: normal 2(b - a), threshold |b|^2 - |a|^2. A vector's nearest centroid is
the winner of a tournament: the holder, first centroid 0, meets every later one,
and the sign of normal . x - threshold eliminates one of them; zero favours the
smaller number. k - 1 linear tests find the winner, whose distance alone is then
computed. All arithmetic is on 64-bit integers and exact.

A round is a scan of the written integer table: each task sums the vectors of
every cluster, the sums per (cluster, component) meet in Spark, and k x (dimensions
+ 1) rows reach the driver. No vector is shuffled.

Defined results: rows without exactly ``dim`` components, with null or non-finite
ones, or with components too large for exact 64-bit sums (2**27 after scaling) are
dropped. Fewer rows than clusters give that many centroids. Rows of one id are
ordered by their components in the choice of the first centroids, null ids come
last; repeated rows each have a result. No rows give no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertflow.llm.common import written
from alertflow.llm.vectors import all_finite, doubles, floors, matrix, small_enough

CLUSTERS, ROUNDS, SCALE, DIM, SEED = 8, 10, 1024.0, 64, 3


def seeded(seed: int = SEED, id_col: str = "vec_id") -> Column:
    """Order of the first centroids: sha256 of ``seed:id`` in hex."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")).cast("binary"), 256)


def bisectors(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normals (a, b, component) and thresholds (a, b) of all pairs."""
    square = (centroids * centroids).sum(1)
    return 2 * (centroids[None, :, :] - centroids[:, None, :]), square[None, :] - square[:, None]


def winners(x: np.ndarray, normals: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """Number of the nearest centroid of each row by k - 1 sign tests."""
    holder = np.zeros(len(x), np.int64)
    for b in range(1, len(thresholds)):
        side = np.einsum("ij,ij->i", x, normals[holder, b]) - thresholds[holder, b]
        holder[side > 0] = b
    return holder


def _sums(centroids: np.ndarray):
    """Per task one row for each (cluster, component) with its sum; component -1 counts the rows."""
    normals, thresholds = bisectors(centroids)

    def work(batches):
        k, dim = centroids.shape
        total = np.zeros((k, dim + 1), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("v"))
            won = winners(x, normals, thresholds)
            order = np.argsort(won, kind="stable")
            names, start = np.unique(won[order], return_index=True)
            total[names, 1:] += np.add.reduceat(x[order], start, axis=0)
            total[names, 0] += np.diff(np.r_[start, len(x)])
        full = np.flatnonzero(total[:, 0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(full, dim + 1)), pa.array(np.tile(np.arange(-1, dim), len(full))), pa.array(total[full].ravel())],
            ["cluster", "component", "total"])
    return work


def _moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: the exact floor of each mean; an empty one stays."""
    sums = (rows.mapInArrow(_sums(centroids), "cluster long, component long, total long")
            .groupBy("cluster", "component").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")))
    got = {(r["cluster"], r["component"]): int(r["total"]) for r in sums.collect()}  # k x (dim + 1) rows
    new = centroids.copy()
    for c in range(len(centroids)):
        if n := got.get((c, -1)):
            new[c] = [got[c, j] // n for j in range(centroids.shape[1])]
    return new


def cluster(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, scale: float = SCALE, dim: int = DIM,
            order: Column | None = None, id_col: str = "vec_id", vec_col: str = "embedding"):
    """``(assigned, centroids)``: ``vec_id, cluster, distance`` of every kept row; ``order`` picks the first centroids."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), doubles(vec_col).alias("x"))
    rows = rows.where((F.size("x") == dim) & all_finite(F.col("x"))).where(small_enough(F.col("x"), scale))
    rows = written(rows.select("vec_id", floors(F.col("x"), scale).alias("v")), "centroid-rows")
    first = rows.orderBy((seeded() if order is None else order).asc_nulls_last(), "v").limit(k).select("v").collect()
    centroids = np.array([r["v"] for r in first], np.int64).reshape(len(first), dim)
    for _ in range(rounds if len(first) else 0):
        centroids = _moved(rows, centroids)
    normals, thresholds = bisectors(centroids)

    def assign(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("v"))
            won = winners(x, normals, thresholds)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(won.astype(np.int32)), pa.array(((x - centroids[won]) ** 2).sum(1))],
                ["vec_id", "cluster", "distance"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    return written(rows.mapInArrow(assign, f"vec_id {kind}, cluster int, distance long"), "centroid-assigned"), centroids


def cluster_digests(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Assigned rows with inertia per cluster and in all, and the digest of their centroid."""
    per = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    known = [(c, int(s), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, s in per.items()]
    facts = assigned.sparkSession.createDataFrame(known, "cluster int, cluster_inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", F.lit(sum(s for _, s, _ in known)).cast("long").alias("inertia"),
        "centroid_sha256")
