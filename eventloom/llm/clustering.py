"""Centroid clustering by delta Lloyd rounds over integer vectors, exact to the last unit.

A table holds every vector's owner and its distance; sums and sizes of the clusters are carried along. In a round,
a vector whose owner stands still is compared with the centroids that have moved only: among those that stand still its
owner is the nearest as before. A vector whose owner has moved is compared with all. Only vectors that change owners
send anything: minus their integers to the old sum, plus to the new one, added up in each task first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.storage import discard, fresh_path

#: Centroids at most (they travel with each task), rounds, and the vectors that are compared at once.
CLUSTERS, ROUNDS, BLOCK = 16, 3, 4096


@dataclass
class Clustering:
    #: (vec_id, q, cluster int, distance long), and the final centroids by number.
    assigned: DataFrame
    centroids: list[list[int]]
    #: For each assignment: centroids that were compared with vectors whose owner stood still, and vectors that changed owners.
    compared: list[int] = field(default_factory=list)
    moved: list[int] = field(default_factory=list)


def _matrix(column: pa.ListArray, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, size)


def _nearest(v: np.ndarray, centroids: np.ndarray, numbers: np.ndarray, cluster: np.ndarray, distance: np.ndarray) -> None:
    """Puts into cluster and distance the nearest of what is there and the centroids of the given numbers; ties go to the smaller number."""
    for c in numbers:
        d = np.square(v - centroids[c]).sum(1)
        better = (d < distance) | ((d == distance) & (c < cluster))
        cluster[better], distance[better] = c, d[better]


def _assign(centroids: np.ndarray, changed: np.ndarray):
    """mapInArrow over (vec_id, q, cluster, distance): the same after a round, and the owner before (-1: none)."""
    size, every, far = centroids.shape[1], np.arange(len(centroids)), np.iinfo(np.int64).max

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                v = _matrix(batch.column(1), size)
                before, distance = batch.column(2).to_numpy().astype(np.int32), batch.column(3).to_numpy().copy()
                cluster = before.copy()
                lost = (before < 0) | np.isin(before, changed)
                for rows, numbers in ((np.flatnonzero(lost), every), (np.flatnonzero(~lost), changed)):
                    own, far_off = cluster[rows], distance[rows]
                    if numbers is every:
                        own[:], far_off[:] = len(every), far
                    _nearest(v[rows], centroids, numbers, own, far_off)
                    cluster[rows], distance[rows] = own, far_off
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cluster), pa.array(distance), pa.array(before)], ["vec_id", "q", "cluster", "distance", "before"])

    return run


def _transfers(k: int, size: int):
    """mapInArrow over (q, cluster, before): a row for each cluster with what the task's vectors add to its size and sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, size + 1), np.int64)
        for batch in batches:
            v = _matrix(batch.column(0), size)
            counted = np.concatenate((np.ones((len(v), 1), np.int64), v), 1)
            after, before = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            np.add.at(sums, after, counted)
            np.subtract.at(sums, before[before >= 0], counted[before >= 0])
        found = np.flatnonzero(sums.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(list(sums[found]), pa.list_(pa.int64()))], ["cluster", "sums"])

    return run


def seeds(vectors: DataFrame, k: int, seed: str) -> list[list[int]]:
    """The k vectors with smallest SHA-256 of '<seed>:<vec_id>', then smallest components; null ids are never among them."""
    hashed = vectors.where("vec_id IS NOT NULL").select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).alias("h"), "q")
    return [list(r.q) for r in hashed.orderBy("h", "q").limit(k).collect()]


def delta_lloyd(vectors: DataFrame, size: int, k: int = CLUSTERS, rounds: int = ROUNDS, seed: str = "1") -> Clustering:
    """Clusters vectors (vec_id long, q array<bigint> of size components) in so many rounds, and assigns them once more.

    A round assigns every vector to the nearest centroid (squared distance, then smaller number) and moves each centroid that
    has vectors to the componentwise floor of their mean. Repeated rows count each; null ids take part but never start a
    cluster. With fewer rows than k there are fewer clusters; without a row that has an id there are no rows.
    """
    spark, state = vectors.sparkSession, None

    def written(df: DataFrame) -> DataFrame:
        nonlocal state
        path = fresh_path(spark, "owners")
        df.write.option("compression", "zstd").parquet(path)
        if state:
            discard(spark, state)  # the round before was read for the last time
        state = path
        return spark.read.schema(df.schema).parquet(path)

    started = "vec_id long, q array<bigint>, cluster int, distance long"
    start = written(vectors.select("vec_id", "q", F.lit(-1).alias("cluster"), F.lit(0).cast("long").alias("distance")))
    centroids = np.array(seeds(start, k, seed), np.int64).reshape(-1, size)
    found = Clustering(start, centroids.tolist())
    if not len(centroids):
        found.assigned = start.where("false")
        return found
    sums, changed, now = [[0] * (size + 1) for _ in centroids], np.arange(len(centroids)), start
    for n in range(rounds + 1):
        found.compared.append(len(changed))
        now = written(now.select("vec_id", "q", "cluster", "distance").mapInArrow(_assign(centroids, changed), f"{started}, before int"))
        moved = now.where("cluster != before")
        found.moved.append(moved.count())
        if n == rounds:
            break
        parts = moved.select("q", "cluster", "before").mapInArrow(_transfers(len(centroids), size), "cluster int, sums array<bigint>")
        # Some k * size numbers, whatever the input.
        added = parts.select("cluster", F.posexplode("sums").alias("at", "x")).groupBy("cluster", "at").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect()
        for r in added:
            sums[r.cluster][r.at] += int(r.x)
        means = np.array([[x // s[0] for x in s[1:]] if s[0] else c.tolist() for s, c in zip(sums, centroids, strict=True)], np.int64).reshape(-1, size)
        changed = np.flatnonzero((means != centroids).any(1))
        centroids = means
    found.assigned, found.centroids = now.select("vec_id", "q", "cluster", "distance"), centroids.tolist()
    return found


def clustering_report(found: Clustering) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256), a row for each vector."""
    spark, rows = found.assigned.sparkSession, found.assigned.select("vec_id", "cluster", "distance")
    digests = [(n, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for n, c in enumerate(found.centroids)]
    named = spark.createDataFrame(digests, "cluster int, centroid_sha256 string")
    # A row for each centroid, and one row.
    sums = rows.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).join(F.broadcast(named), "cluster")
    every = rows.agg(F.sum("distance").alias("inertia"))
    return rows.join(F.broadcast(sums), "cluster").crossJoin(F.broadcast(every)).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
