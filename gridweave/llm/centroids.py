"""Centroid clustering in whole numbers, assigned by the threshold algorithm.

Every dimension has a list of the centroids, sorted by their value in it. A vector walks each list
outward from its own value, one entry per list and step. A centroid met for the first time gets its
exact squared distance. A centroid not met yet is at least as far in every dimension as the entry
reached there, so the walk stops when the sum of these squared frontier distances is strictly larger
than the best exact distance: then nothing unseen can win or tie.

Components are floor(scale * x), so sums and distances are exact and the result depends on neither
the order of rows nor their partitions. A round is one pass over the vectors: a task sends one row
of sums per centroid, and only centroids times dimensions numbers reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridweave.llm.common import written
from gridweave.llm.vectors import as_binary, finite_rows, from_binary

Batches = Iterator[pa.RecordBatch]

ROWS = 2048  # vectors walked at a time
_FAR = np.int64(1) << 30


def largest(dims: int) -> int:
    """The largest whole component, so that squared distances stay within long."""
    return min(1 << 27, int((2**62 / dims) ** 0.5) // 2)


def nearest(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each point (the smaller of equally near ones), and the
    squared distance, by walking the sorted lists of the dimensions."""
    points, centroids = points.astype(np.int64), centroids.astype(np.int64)
    (n, dims), k = points.shape, len(centroids)
    order = np.argsort(centroids, axis=0, kind="stable")
    values = np.take_along_axis(centroids, order, axis=0)
    dim = np.arange(dims)
    after = np.stack([np.searchsorted(values[:, d], points[:, d]) for d in dim], axis=1)
    before = after - 1
    best = np.full(n, np.iinfo(np.int64).max)
    found = np.zeros(n, np.int64)
    seen = np.zeros((n, k), bool)
    at = np.arange(n)  # points whose walk goes on
    for _ in range(k):
        x, low, high = points[at], before[at], after[at]
        down = np.where(low >= 0, x - values[np.maximum(low, 0), dim], _FAR)
        up = np.where(high < k, values[np.minimum(high, k - 1), dim] - x, _FAR)
        downward = down <= up
        frontier = np.where(downward, down, up)
        met = order[np.where(downward, low, high), dim]
        before[at] = low - downward
        after[at] = high + ~downward
        fresh = np.zeros((len(at), k), bool)
        fresh[np.arange(len(at))[:, None], met] = True
        fresh &= ~seen[at]
        seen[at] |= fresh
        for c in np.flatnonzero(fresh.any(axis=0)):
            rows = np.flatnonzero(fresh[:, c])
            who = at[rows]
            distance = ((x[rows] - centroids[c]) ** 2).sum(axis=1)
            wins = (distance < best[who]) | ((distance == best[who]) & (c < found[who]))
            best[who[wins]], found[who[wins]] = distance[wins], c
        at = at[(frontier**2).sum(axis=1) <= best[at]]
        if not len(at):
            break
    return found, best


def _whole(dims: int, scale: int) -> Callable[[Batches], Batches]:
    """vec_id and whole components of the vectors that take part."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            rows, x = finite_rows(batch["embedding"], dims)
            x = np.floor(scale * x)
            if np.abs(x).max(initial=0) > largest(dims):
                raise ValueError(f"a component times {scale} is beyond {largest(dims)}")
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"].take(pa.array(rows)), as_binary(x.astype(np.int32))],
                ["vec_id", "point"],
            )

    return run


def _assigned(batches: Batches, centroids: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray, ...]]:
    """Slices of the batches with their points, centroid numbers and distances."""
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS):
            rows = batch.slice(lo, ROWS)
            points = from_binary(rows["point"], np.int32, centroids.shape[1])
            yield rows, points, *nearest(points, centroids)


def _sums(centroids: np.ndarray) -> Callable[[Batches], Batches]:
    """Per task and centroid: how many vectors are nearest to it, and their sums."""

    def run(batches: Batches) -> Batches:
        k, dims = centroids.shape
        n, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for _, points, cluster, _ in _assigned(batches, centroids):
            n += np.bincount(cluster, minlength=k)
            for c in range(k):
                total[c] += points[cluster == c].sum(axis=0, dtype=np.int64)
        some = np.flatnonzero(n)
        offsets = pa.array(np.arange(len(some) + 1, dtype=np.int32) * dims)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(some.astype(np.int32)),
                pa.array(n[some]),
                pa.ListArray.from_arrays(offsets, pa.array(total[some].ravel())),
            ],
            ["cluster", "n", "total"],
        )

    return run


def _last(centroids: np.ndarray) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for rows, _, cluster, distance in _assigned(batches, centroids):
            yield pa.RecordBatch.from_arrays(
                [rows["vec_id"], pa.array(cluster.astype(np.int32)), pa.array(distance)],
                ["vec_id", "cluster", "distance"],
            )

    return run


def _moved(points: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: floor of the mean of their vectors; empty ones stay."""
    sums = (
        points.select("point")
        .mapInArrow(_sums(centroids), "cluster int, n long, total array<long>")
        .selectExpr("cluster", "n", "posexplode(total) as (dim, part)")
        .groupBy("cluster", "dim")
        .agg(F.sum("n").alias("n"), F.sum("part").alias("total"))
        .selectExpr("cluster", "dim", "n", "total")
        .collect()  # centroids times dimensions rows
    )
    moved = centroids.copy()
    for row in sums:
        moved[row["cluster"], row["dim"]] = row["total"] // row["n"]
    return moved


def digest(centroid: np.ndarray) -> str:
    """Lower-case hex SHA-256 of the components in decimal, joined by commas."""
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def clusters(
    vectors: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3, dims: int = 64, scale: int = 1024
) -> DataFrame:
    """Clusters of `vectors` (vec_id, embedding): a row per vector that takes part.

    Columns vec_id, cluster, distance (squared), cluster_inertia, inertia (distances summed over the
    cluster and over all), centroid_sha256. Vectors with other than `dims` components, null ones and
    those with a null or non-finite component take no part. Components are floor(scale * x); one
    beyond `largest` is an error, since distances would leave the range of long.

    The `k` first centroids are the vectors with the smallest SHA-256 of "seed:vec_id" (equal ids:
    in the order of their bytes), in that order; with fewer vectors there are fewer centroids.
    Vectors without vec_id never start a centroid but are assigned; if no vector has an id, there
    are no rows. Repeated rows count as often as they occur. Equally near centroids: the smaller number. An empty table gives no rows; other
    columns are ignored.
    """
    points = written(
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(
            _whole(dims, scale), "vec_id long, point binary"
        ),
        "points",
    )
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    starts = (
        points.filter("vec_id is not null").orderBy(order, "point").limit(k).select("point").collect()
    )
    columns = (
        "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
        "centroid_sha256 string"
    )
    if not starts:
        return vectors.sparkSession.createDataFrame([], columns)
    centroids = np.stack([np.frombuffer(r["point"], np.int32) for r in starts]).astype(np.int64)
    for _ in range(rounds):
        centroids = _moved(points, centroids)
    assigned = written(
        points.mapInArrow(_last(centroids), "vec_id long, cluster int, distance long"), "assigned"
    )
    # a row per centroid: its sum, and the digest that only the driver knows
    sums = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    whole = sum(sums.values())
    of = vectors.sparkSession.createDataFrame(
        [(c, s, whole, digest(centroids[c])) for c, s in sums.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return assigned.join(F.broadcast(of), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
