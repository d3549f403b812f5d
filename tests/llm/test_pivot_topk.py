import numpy as np
import pytest
from pyspark.sql import functions as F

from gridweave.llm.pivot_topk import top_k

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, k):
    ok = {}
    for i, v, _ in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            ok.setdefault((i, tuple(v)), np.floor(64 * np.array(v, np.float64)))
    out = []
    for (q, _), x in ok.items():
        if q % 20 == 0:
            found = sorted((-int(x @ y), i) for (i, _), y in ok.items() if i != q)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


def rows_of(kind):
    rng = np.random.RandomState(3)
    if kind == "clusters":
        c = rng.randn(5, 8)
        v = c[rng.randint(5, size=300)] + 0.1 * rng.randn(300, 8)
    elif kind == "ties":
        v = rng.randint(-2, 3, (300, 4)) / 4
    else:  # a third of the rows are one vector
        v = rng.randn(300, 8)
        v[:100] = v[0]
    return [(i, [float(np.float32(x)) for x in row], 0) for i, row in enumerate(v)]


@pytest.mark.parametrize("kind", ["clusters", "ties", "one vector"])
def test_matches_brute_force(spark, kind):
    rows = rows_of(kind)
    got = top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, k=7, pivots=6)
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, 7)


def test_nulls_few_and_no_rows(spark):
    rows = [
        (0, [1.0, 2.0], 0), (0, [1.0, 2.0], 0), (1, None, 0), (2, [1.0, None], 0),
        (3, [float("nan"), 1.0], 0), (4, [0.5, -1.0], 0), (None, [9.0, 9.0], 0), (5, [float("inf"), 0.0], 0),
    ]
    got = top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0)
    assert [tuple(r) for r in got.collect()] == [(0, 1, 4, 64 * 32 - 128 * 64)]
    assert top_k(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 20 == 0).collect() == []
