"""Clusters against plain rounds over all distances."""

import hashlib
import math

import numpy as np
import pytest

from gridweave.llm.centroids import clusters, nearest

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, k=8, rounds=10, seed=3, dims=64, scale=1024):
    kept = [
        (i, np.array([math.floor(scale * float(np.float32(x))) for x in v], dtype=object))
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    starts = sorted(
        (hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), n) for n, (i, _) in enumerate(kept) if i is not None
    )
    centroids = [kept[n][1] for _, n in starts[:k]]

    def assigned():
        for i, v in kept:
            distances = [int(((v - c) ** 2).sum()) for c in centroids]
            yield i, v, distances.index(min(distances)), min(distances)

    for _ in range(rounds):
        groups = {}
        for _, v, c, _ in assigned():
            groups.setdefault(c, []).append(v)
        for c, vs in groups.items():
            centroids[c] = np.array([int(x) // len(vs) for x in sum(vs)], dtype=object)
    last = list(assigned())
    inertia = {}
    for _, _, c, d in last:
        inertia[c] = inertia.get(c, 0) + d
    name = lambda c: hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()
    return sorted(
        ((i, c, d, inertia[c], sum(inertia.values()), name(c)) for i, _, c, d in last), key=str
    )


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def vectors(n, seed, dims=64):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(5, dims))
    x = middle[rng.integers(0, 5, n)] + 0.4 * rng.normal(size=(n, dims))
    return [(i, [float(v) for v in row.astype(np.float32)]) for i, row in enumerate(x)]


def test_as_plain_rounds(spark):
    rows = vectors(300, 1)
    assert got(clusters(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_odd_rows(spark):
    rows = vectors(60, 2)
    bad = [
        (100, None), (101, []), (102, rows[0][1][:63]), (103, [None, *rows[0][1][1:]]),
        (104, [float("nan"), *rows[0][1][1:]]), (105, [float("inf"), *rows[0][1][1:]]),
        (106, rows[0][1] * 2), (None, None),
    ]
    odd = [(None, rows[3][1]), rows[4], rows[4], *[(200 + i, rows[5][1]) for i in range(50)]]
    frame = spark.createDataFrame(rows + bad + odd, SCHEMA).selectExpr(
        "*", "1 as cluster", "2 as distance", "3 as point", "4 as inertia", "5 as n"
    )
    assert got(clusters(frame)) == plain(rows + odd)


def test_few_and_none(spark):
    rows = vectors(3, 3)
    assert got(clusters(spark.createDataFrame(rows, SCHEMA))) == plain(rows)
    assert clusters(spark.createDataFrame([], SCHEMA)).collect() == []
    assert clusters(spark.createDataFrame([(1, None)], SCHEMA)).collect() == []


def test_equal_vectors_leave_centroids_empty(spark):
    rows = [(i, [0.5] * 64) for i in range(30)] + [(99, [0.25] * 64)]
    assert got(clusters(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_components_too_large(spark):
    rows = [(1, [1e9] * 64)]
    with pytest.raises(Exception, match="beyond"):
        clusters(spark.createDataFrame(rows, SCHEMA)).collect()


@pytest.mark.parametrize("k", [1, 2, 8, 40])
def test_the_walk_finds_the_nearest(k):
    rng = np.random.default_rng(k)
    points = rng.integers(-4, 5, (500, 6))
    centroids = rng.integers(-4, 5, (k, 6))
    want = ((points[:, None] - centroids[None]) ** 2).sum(axis=2)
    found, distance = nearest(points, centroids)
    assert (distance == want.min(axis=1)).all()
    assert (found == want.argmin(axis=1)).all()  # the first of equal ones
