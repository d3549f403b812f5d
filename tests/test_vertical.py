"""Properties of vertical operators."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridweave.operators import vertical

SOURCE = "time int, dst_id long, z double, value double"
TARGET = "time int, dst_id long, lev_idx int, x double"


def run(spark, source, targets, schema=TARGET, **options):
    out = vertical.vertical_interpolation(
        spark.createDataFrame(source, SOURCE), spark.createDataFrame(targets, schema), **options
    )
    return {(r["time"], r["dst_id"], r["lev_idx"]): r["value"] for r in out.collect()}


def used(column, missing):
    return [(z, v) for z, v in column if z is not None and (v is not None or missing == "break")]


def brute(source, x, above, missing):
    """Straight re-statement for one column."""
    pts = sorted(used(source, missing), key=lambda p: p[0])
    if len(pts) < 2 or x is None:
        return None
    zs = [p[0] for p in pts]
    if x > zs[-1]:
        if above == "null":
            return None
        i = len(pts) - 2
    else:
        i = max(0, int(np.searchsorted(zs, x, side="left")) - 1)
    (z0, v0), (z1, v1) = pts[i], pts[i + 1]
    return None if z0 == z1 or v0 is None or v1 is None else v0 + (v1 - v0) * (x - z0) / (z1 - z0)


@pytest.mark.parametrize("above", ["null", "extrapolate"])
@pytest.mark.parametrize("static", [False, True])
@pytest.mark.parametrize("missing", ["break", "bridge"])
def test_against_brute_force(spark, above, static, missing):
    rng = np.random.default_rng(3)
    columns, source, targets = {}, [], []
    for t in range(3):
        for c in range(5):
            n = int(rng.integers(1, 12))
            z = [float(v) for v in rng.integers(0, 40, n) * 100.0]
            v = [None if rng.random() < 0.15 else float(rng.normal()) for _ in z]
            columns[t, c] = list(zip(z, v))
            source += [(t, c, a, b) for a, b in columns[t, c]]
    xs = {c: [float(x) for x in rng.integers(-5, 50, 9) * 100.0] for c in range(5)}
    if static:
        targets = [(c, i, x) for c in xs for i, x in enumerate(xs[c])]
        got = run(spark, source, targets, "dst_id long, lev_idx int, x double", above=above, missing=missing)
    else:
        targets = [(t, c, i, x) for t in range(3) for c in xs for i, x in enumerate(xs[c])]
        got = run(spark, source, targets, above=above, missing=missing)
    for (t, c), column in columns.items():
        heights = [z for z, _ in used(column, missing)]
        for i, x in enumerate(xs[c]):
            want = brute(column, x, above, missing)
            if static and not heights:
                assert (t, c, i) not in got
                continue
            if len(set(heights)) != len(heights):
                continue  # equal heights are tested on their own
            assert got[t, c, i] == (None if want is None else pytest.approx(want, abs=1e-9))


def test_ends_ties_and_missing(spark):
    source = [(0, 0, 10.0, 1.0), (0, 0, 20.0, 3.0), (0, 0, 40.0, 4.0), (0, 0, 50.0, None)]
    source += [(0, 1, 5.0, 9.0)]  # one level
    source += [(0, 2, 5.0, 1.0), (0, 2, 5.0, 2.0)]  # equal heights
    xs = [10.0, 20.0, 40.0, 0.0, 41.0, None]
    targets = [(0, c, i, x) for c in range(4) for i, x in enumerate(xs)]
    got = run(spark, source, targets)
    assert [got[0, 0, i] for i in range(6)] == [1.0, 3.0, 4.0, -1.0, None, None]
    for c in (1, 2, 3):
        assert [got[0, c, i] for i in range(6)] == [None] * 6
    assert run(spark, source, targets, above="extrapolate")[0, 0, 4] is None
    up = run(spark, source, targets, above="extrapolate", missing="bridge")
    assert up[0, 0, 4] == pytest.approx(4.05)


def test_linear_profile_and_kept_columns(spark):
    source = spark.createDataFrame(
        [(0, 0, float(z), 2.0 + 0.5 * z) for z in (1, 4, 9, 16, 25)], SOURCE
    )
    targets = spark.createDataFrame(
        [(0, 0, i, float(x), f"n{i}") for i, x in enumerate((-3, 2, 20, 25))],
        TARGET + ", note string",
    )
    out = vertical.vertical_interpolation(source, targets).collect()
    assert len(out) == 4
    for r in out:
        assert r["value"] == pytest.approx(2.0 + 0.5 * r["x"]) and r["note"] == f"n{r['lev_idx']}"


def test_missing_levels_break_lines_or_are_bridged(spark):
    """Values missing at 0 and 100, given at 200, 300 and 500."""
    source = spark.createDataFrame(
        [(0, 0, float(z), None if z < 200 else z / 10.0) for z in (0, 100, 200, 300, 500)], SOURCE
    )
    targets = spark.createDataFrame([(0, 0, i, float(x)) for i, x in enumerate((50, 150, 250, 400))], TARGET)
    got = lambda rule: [
        r["value"] for r in vertical.vertical_interpolation(source, targets, missing=rule).orderBy("lev_idx").collect()
    ]
    assert got("break") == [None, None, 25.0, 40.0]
    assert got("bridge") == [5.0, 15.0, 25.0, 40.0]
    with pytest.raises(ValueError):
        vertical.vertical_interpolation(source, targets, missing="guess")


def test_one_exchange_for_all_windows(spark):
    source = spark.createDataFrame([(0, 0, 1.0, 1.0)], SOURCE)
    targets = spark.createDataFrame([(0, 0, 0, 1.0)], TARGET)
    plan = vertical.vertical_interpolation(source, targets, above="extrapolate")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1
    assert "Join" not in text and "Cartesian" not in text


def test_isothermal_column(spark):
    rows = [(0, 0, i, p, 250.0) for i, p in enumerate((100000.0, 85000.0, 50000.0, 20000.0))]
    df = spark.createDataFrame(rows, "time int, dst_id long, lev_idx int, p double, t double")
    got = {r["lev_idx"]: r["zfull"] for r in vertical.hypsometric_heights(df).collect()}
    for _, _, i, p, _ in rows:
        assert got[i] == pytest.approx(287.05 / 9.80665 * 250 * math.log(100000 / p))


def test_hypsometric_skips_bad_layers_and_uses_humidity(spark):
    rows = [(0, 0, 0, 100000.0, 250.0, 0.01), (0, 0, 1, 0.0, 250.0, 0.01), (0, 0, 2, 50000.0, 250.0, 0.01)]
    schema = "time int, dst_id long, lev_idx int, p double, t double, q double"
    df = spark.createDataFrame(rows, schema)
    assert [r["zfull"] for r in vertical.hypsometric_heights(df).orderBy("lev_idx").collect()] == [0.0] * 3
    good = df.where("p > 0")
    dry = vertical.hypsometric_heights(good).agg(F.max("zfull")).first()[0]
    moist = vertical.hypsometric_heights(good, q="q").agg(F.max("zfull")).first()[0]
    assert moist == pytest.approx(dry * (1 + 0.609133 * 0.01))


def test_edges_continue_the_outer_steps(spark):
    rows = [(0, 0, i, z) for i, z in ((3, 10.0), (4, 30.0), (7, 35.0))]
    df = spark.createDataFrame(rows, "time int, dst_id long, lev_idx int, z double")
    got = vertical.adjust_edges(df).orderBy("lev_idx").collect()
    assert [(r["lev_idx"], r["z"]) for r in got] == [(0, -10.0), (1, 10.0), (2, 30.0), (3, 35.0), (4, 40.0)]


def test_levels_over_a_surface(spark):
    ps = spark.createDataFrame([(0, 1, 100000.0), (0, 2, 90000.0)], "time int, dst_id long, ps double")
    coef = spark.createDataFrame([(0, 0.0, 1.0), (1, 5000.0, 0.5)], "lev_idx int, ap double, b double")
    got = {(r["dst_id"], r["lev_idx"]): r["p"] for r in vertical.pressure_levels(ps, coef).collect()}
    assert got == {(1, 0): 100000.0, (1, 1): 55000.0, (2, 0): 90000.0, (2, 1): 50000.0}
