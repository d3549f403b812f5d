"""Neighbours by posting lists against all inner products."""

import numpy as np
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridweave.llm import posting_lists as lists
from gridweave.llm.posting_lists import Shelves, chosen, halved, linked, neighbours

SCHEMA = "vec_id long, embedding array<double>"


def asked(vectors: DataFrame, **options) -> DataFrame:
    return neighbours(vectors, F.col("vec_id") % 20 == 0, **options)


def truth(rows, k=20):
    best = {}
    for q, a in rows:
        if q % 20:
            continue
        for v, b in rows:
            if v != q:
                score = float((np.array(a) * np.array(b)).sum())
                best.setdefault(q, {})
                best[q][v] = max(score, best[q].get(v, -np.inf))
    return {q: sorted(s.items(), key=lambda x: (-x[1], x[0]))[:k] for q, s in best.items()}


def got(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(found, want):
    hits = sum(len({v for v, _ in found.get(q, [])} & {v for v, _ in w}) for q, w in want.items())
    return hits / sum(map(len, want.values()))


def as_rows(x):
    return [(i, row.tolist()) for i, row in enumerate(x)]


def shapes():
    rng = np.random.default_rng(1)
    yield "shapeless", rng.normal(size=(1500, 24))
    middle = rng.normal(size=(30, 24)) * 3
    yield "clustered", middle[rng.integers(0, 30, 1500)] + 0.3 * rng.normal(size=(1500, 24))
    yield "of many lengths", rng.normal(size=(1500, 24)) * rng.lognormal(0, 0.7, (1500, 1))


@pytest.mark.parametrize(("name", "x"), list(shapes()), ids=lambda v: v if isinstance(v, str) else "")
def test_recall(spark, name, x):
    rows = as_rows(x)
    found = got(asked(spark.createDataFrame(rows, SCHEMA), size=32))
    want = truth(rows)
    assert found.keys() == want.keys()
    assert recall(found, want) >= 0.9
    vectors = dict(rows)
    for q, row in found.items():
        assert len(row) == 20 and len({v for v, _ in row}) == 20 and q not in {v for v, _ in row}
        assert row == sorted(row, key=lambda p: (-p[1], p[0]))
        for v, score in row:
            assert score == pytest.approx(float(np.dot(vectors[q], vectors[v])), rel=1e-12, abs=1e-12)


def test_of_clustered_vectors_few_lists_are_read(spark, monkeypatch):
    rng = np.random.default_rng(2)
    middle = rng.normal(size=(64, 16)) * 4
    x = middle[np.arange(4096) % 64] + 0.05 * rng.normal(size=(4096, 16))
    ratios = []
    real = lists.measured_ratio
    monkeypatch.setattr(lists, "measured_ratio", lambda *a: ratios.append((a[2], real(*a))) or ratios[-1][1])
    rows = as_rows(x)
    found = got(asked(spark.createDataFrame(rows, SCHEMA), size=64))
    graph, ratio = ratios[0]
    points = np.concatenate([x[::20], np.zeros((len(x[::20]), 1))], axis=1)
    gaps = np.sqrt(((points[:, None] - graph.centroids[None]) ** 2).sum(axis=2))
    share = (gaps <= ratio * gaps.min(axis=1, keepdims=True)).mean()
    print("share of lists read", share)
    assert share < 0.25
    assert recall(found, truth(rows)) >= 0.9


def test_few_vectors_are_all_found(spark):
    rng = np.random.default_rng(3)
    rows = as_rows(rng.normal(size=(15, 8)))
    found = got(asked(spark.createDataFrame(rows, SCHEMA)))
    want = truth(rows)
    assert {q: [v for v, _ in r] for q, r in found.items()} == {q: [v for v, _ in r] for q, r in want.items()}
    assert len(found[0]) == 14


def test_odd_rows(spark):
    rng = np.random.default_rng(4)
    rows = as_rows(rng.normal(size=(41, 8)))
    bad = [
        (60, None), (80, []), (100, [0.0] * 8), (120, [float("nan")] * 8), (140, [None] * 8),
        (160, [1.0] * 7), (None, [9.0] * 8), (61, [float("inf")] * 8),
    ]
    frame = spark.createDataFrame(rows + rows[:5] + bad, SCHEMA).selectExpr(
        "*", "1 as shard", "2 as kind", "3 as list", "4 as score", "5 as rank", "6 as asks"
    )
    found = got(asked(frame))
    want = truth(rows)
    assert {q: [v for v, _ in r] for q, r in found.items()} == {q: [v for v, _ in r] for q, r in want.items()}


def test_none(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert asked(empty).collect() == []
    assert asked(spark.createDataFrame([(1, [1.0, 2.0])], SCHEMA)).collect() == []
    assert asked(spark.createDataFrame([(0, [0.0, 0.0])], SCHEMA)).collect() == []
    assert asked(spark.createDataFrame([(0, [1.0, 0.0])], SCHEMA)).collect() == []


def test_many_copies_are_ranked_by_id(spark):
    """A third of all vectors are equal: their list is dealt over shelves, and ties keep their order."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(900, 8))
    x[::3] = x[0]
    rows = as_rows(x / np.linalg.norm(x, axis=1, keepdims=True))
    found = got(asked(spark.createDataFrame(rows, SCHEMA), size=32, shelf=64))
    copies = [i for i in range(900) if i % 3 == 0]
    for q in range(0, 900, 60):  # queries that are copies themselves
        assert [v for v, _ in found[q]] == [c for c in copies if c != q][:20]
    assert recall(found, truth(rows)) >= 0.9


def test_an_id_with_several_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0])]
    found = got(asked(spark.createDataFrame(rows, SCHEMA)))
    assert found == {0: [(1, 2.0), (2, 1.0)]}


def test_single_precision_is_not_rounded(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(rng.normal(size=(50, 8)).astype(np.float32))]
    found = got(asked(spark.createDataFrame(rows, "vec_id long, embedding array<float>")))
    assert found.keys() == truth(rows).keys()
    for q, row in truth(rows).items():
        assert [v for v, _ in found[q]] == [v for v, _ in row]


def test_leaves_are_balanced_and_the_graph_reaches_all():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(2048, 10))
    graph = linked(halved(x, 64))
    assert len(graph.centroids) == 64
    near = graph.near(x[:200], 10.0, 4)
    exact = np.sqrt(((x[:200, None] - graph.centroids[None]) ** 2).sum(axis=2))
    assert np.allclose(near, exact)
    few = graph.near(x[:200], 1.0, 8)
    assert (few.argmin(axis=1) == exact.argmin(axis=1)).mean() > 0.95
    rows, of = chosen(exact, graph, 1.5, 4)
    assert (np.bincount(rows) <= 4).all() and (np.bincount(rows) >= 1).all() and len(rows) > 200
    nearest = dict(zip(rows[::-1].tolist(), of[::-1].tolist(), strict=True))
    assert all(nearest[i] == exact[i].argmin() for i in range(200))


def test_shelves():
    shelves = Shelves.of(np.array([3, 3, 3, 25, 2, 0, 9]), 10)
    assert shelves.first.tolist() == [0, 0, 0, 1, 4, 4, 5]
    assert shelves.pieces.tolist() == [1, 1, 1, 3, 1, 1, 1]
