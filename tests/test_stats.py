"""Statistics and corrections against numpy, including a hot group."""

import datetime as dt
import re

import numpy as np
import pandas as pd
import pytest

from gridweave.operators import correct, stats

START = dt.datetime(2000, 1, 1)


def series(rng, n=400, cells=3, hot=0):
    rows = []
    for c in range(cells):
        for i in range(n * (20 if c == hot else 1)):
            rows.append((c, START + dt.timedelta(hours=6 * i), float(rng.normal(c, 1 + c))))
    return pd.DataFrame(rows, columns=["cell", "time", "value"])


def frame(spark, pdf):
    return spark.createDataFrame(pdf, "cell int, time timestamp_ntz, value double")


def test_hot_group_statistics(spark):
    pdf = series(np.random.default_rng(1))
    df = frame(spark, pdf)
    for r in stats.climatology(df, ["cell"]).collect():
        v = pdf[pdf.cell == r["cell"]].value
        assert (r["mean"], r["std"], r["n"]) == (pytest.approx(v.mean()), pytest.approx(v.std()), len(v))
    for r in stats.lag1_autocorrelation(df).collect():
        v = pdf[pdf.cell == r["cell"]].value.to_numpy()
        assert r["lag1"] == pytest.approx(np.corrcoef(v[1:], v[:-1])[0, 1])
        assert r["n"] == len(v) - 1


def test_quantiles_are_exact_with_ties(spark):
    rng = np.random.default_rng(2)
    pdf = series(rng)
    pdf["value"] = np.where(rng.random(len(pdf)) < 0.4, 1.25, pdf.value)
    probs = (0.0, 0.01, 0.25, 0.5, 0.9, 1.0)
    got = {(r["cell"], r["p"]): r["quantile"] for r in stats.quantiles(frame(spark, pdf), probs, 0.3, ["cell"]).collect()}
    assert len(got) == 3 * len(probs)
    for c, g in pdf.groupby("cell"):
        for p in probs:
            assert got[c, p] == pytest.approx(np.quantile(g.value, p))


def test_moment_correction_moves_mean_and_spread(spark):
    rng = np.random.default_rng(4)
    model, observed = series(rng, 200), series(rng, 300)
    observed["value"] = observed.value * 3 + 10
    out = correct.moment_correction(frame(spark, model), frame(spark, model), frame(spark, observed), ["cell"])
    got = out.toPandas()
    for c, g in got.groupby("cell"):
        v = observed[observed.cell == c].value
        assert g.corrected.mean() == pytest.approx(v.mean())
        assert g.corrected.std() == pytest.approx(v.std())


def test_multivariate_correction_takes_the_observed_dependence(spark):
    rng = np.random.default_rng(5)
    n = 6000

    def pair(a, mix):
        x = np.zeros((n, 2))
        for t in range(1, n):
            x[t] = a @ x[t - 1] + mix @ rng.normal(size=2)
        return pd.DataFrame(
            {"cell": 1, "time": [START + dt.timedelta(hours=6 * i) for i in range(n)], "t": x[:, 0], "q": x[:, 1]}
        )

    model = pair(np.array([[0.2, 0.0], [0.1, 0.3]]), np.array([[1.0, 0.0], [-0.5, 1.0]]))
    observed = pair(np.array([[0.8, 0.1], [0.0, 0.6]]), np.array([[2.0, 0.0], [1.5, 1.0]]))
    observed["t"] += 20
    schema = "cell int, time timestamp_ntz, t double, q double"
    out = correct.multivariate_correction(
        spark.createDataFrame(model, schema), spark.createDataFrame(observed, schema), ["t", "q"]
    ).toPandas().sort_values("time")
    assert len(out) == n
    out[["t", "q"]] = out[["corrected_t", "corrected_q"]]

    # half of the observed steps missing: neighbours are still those one step apart
    half = observed[rng.random(n) < 0.5]
    gaps = correct.multivariate_correction(
        spark.createDataFrame(model, schema), spark.createDataFrame(half, schema), ["t", "q"]
    ).toPandas().sort_values("time")
    lag = lambda x: np.corrcoef(x[1:], x[:-1])[0, 1]
    assert lag(gaps.corrected_t) == pytest.approx(lag(observed.t), abs=0.06)

    def shape(p):
        v = p[["t", "q"]].to_numpy()
        z = (v - v.mean(0)) / v.std(0)
        return v.mean(0), v.std(0), z.T @ z / n, z[1:].T @ z[:-1] / n

    for got, want, tol in zip(shape(out), shape(observed), (0.7, 0.5, 0.08, 0.08)):
        assert np.abs(got - want).max() < tol


def test_multivariate_correction_keeps_every_row(spark):
    schema = "cell int, time timestamp_ntz, t double, q double"
    at = lambda i: START + dt.timedelta(hours=6 * i)
    rows = [(1, at(i), float(i % 3), float(i % 5)) for i in range(20)]
    model = [*rows, (1, at(30), None, 1.0), (1, at(3), 0.0, 0.0), (2, at(0), 1.0, 1.0)]
    m, o = spark.createDataFrame(model, schema), spark.createDataFrame(rows, schema)
    out = correct.multivariate_correction(m, o, ["t", "q"], calibration=o).collect()
    assert len(out) == len(model)
    known = {(r["cell"], r["time"]): r["corrected_t"] for r in out}
    assert known[1, at(30)] is None and known[2, at(0)] is None and known[1, at(4)] is not None


def test_pairs_average_repeated_rows(spark):
    rows = [(1, START, "a", 1.0), (1, START, "a", 3.0), (1, START, "b", 5.0), (1, START, "c", 9.0)]
    df = spark.createDataFrame(rows, "cell int, time timestamp_ntz, var string, value double")
    got = {(r["a"], r["b"]): r["bias"] for r in stats.mean_absolute_biases(df).collect()}
    assert got == {("a", "b"): 3.0, ("a", "c"): 7.0, ("b", "c"): 4.0}


def test_spin_up_counts_from_the_first_time(spark):
    times = [dt.datetime(1981, 12, 1), dt.datetime(1982, 1, 1), dt.datetime(1982, 12, 1)]
    df = spark.createDataFrame([(x,) for x in times], "time timestamp_ntz")
    assert [r["time"] for r in stats.drop_spin_up(df).collect()] == times[2:]


def test_record_checks(spark):
    pdf = pd.DataFrame({"cell": [1, 1, 2], "time": [START, START.replace(year=2001), START], "value": 1.0})
    df = frame(spark, pdf)
    assert [(r["cell"], r["years"]) for r in stats.short_records(df, minimum_years=2).collect()] == [(2, 1)]
    assert stats.drop_spin_up(df).count() == 1


def _loop_correction(model, observed, step):
    """The correction of one cell's complete series (arrays of times and values), row by row."""

    def moments(times, x):
        t = np.flatnonzero(np.diff(times, prepend=times[0]) == step)
        mean, std = x.mean(axis=0), x.std(axis=0, ddof=1)
        std = np.where(std > 0, std, 1.0)
        z = (x - mean) / std
        return z, mean, std, z.T @ z / (len(z) - 1), z[t].T @ z[t - 1] / len(t), set(t)

    z, _, _, g0, g1, follows = moments(*model)
    _, mean, std, h0, h1, _ = moments(*observed)
    f, c = g1 @ np.linalg.pinv(g0), h1 @ np.linalg.pinv(h0)
    whiten, colour = correct._roots(g0 - f @ g1.T)[1], correct._roots(h0 - c @ h1.T)[0]
    out = np.zeros_like(z)
    for t in range(len(z)):
        if t in follows:
            out[t] = c @ out[t - 1] + colour @ whiten @ (z[t] - f @ z[t - 1])
        else:
            out[t] = correct._roots(h0)[0] @ correct._roots(g0)[1] @ z[t]
    return out * std + mean


def test_multivariate_correction_by_chunks_equals_the_loop(spark):
    rng = np.random.default_rng(11)
    step = np.timedelta64(6, "h")

    def series(cell):
        # gaps, and rows between the steps, which end a run
        steps = np.flatnonzero(rng.random(300) < 0.9)
        offs = np.where(rng.random(len(steps)) < 0.03, np.timedelta64(2, "h"), np.timedelta64(0, "h"))
        times = np.datetime64(START) + steps * step + offs
        return times.astype("datetime64[us]"), rng.normal(size=(len(steps), 3)).cumsum(axis=0) + 250.0 * cell

    model, observed = {c: series(c) for c in (1, 2)}, {c: series(c) for c in (1, 2)}
    schema = "cell int, time timestamp_ntz, a double, b double, c double"

    def table(cells):
        rows = [
            (c, t.astype("datetime64[us]").item(), *map(float, x))
            for c, (times, values) in cells.items() for t, x in zip(times, values, strict=True)
        ]
        return spark.createDataFrame(rows, schema)

    want = {c: _loop_correction(model[c], observed[c], step) for c in model}
    # chunks of one step, of a few, and one chunk for all
    for chunk in (1, 7, 4096):
        got = correct.multivariate_correction(
            table(model), table(observed), ["a", "b", "c"], chunk=chunk
        ).toPandas().sort_values(["cell", "time"])
        for c in model:
            mine = got[got.cell == c][["corrected_a", "corrected_b", "corrected_c"]].to_numpy()
            assert np.allclose(mine, want[c], rtol=0, atol=1e-6)


def test_multivariate_correction_spreads_one_cell_over_tasks(spark):
    rows = [(1, START + dt.timedelta(hours=6 * i), float(i % 7), float(i % 5)) for i in range(400)]
    df = spark.createDataFrame(rows, "cell int, time timestamp_ntz, t double, q double")
    out = correct.multivariate_correction(df, df, ["t", "q"], chunk=20)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # series are grouped by cell and chunk; only the row per chunk is grouped by cell alone
    grouped = re.findall(r"FlatMapGroupsInPandas \[([^\]]*)\]", plan)
    assert ["_chunk" in g for g in grouped] in ([True, False], [False, True])
    assert "FlatMapCoGroupsInPandas 2, 2" in plan
    # a model equal to what is observed is not changed
    got = out.toPandas()
    assert np.allclose(got.corrected_t, got.t, atol=1e-6) and np.allclose(got.corrected_q, got.q, atol=1e-6)
