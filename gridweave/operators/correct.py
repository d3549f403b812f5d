"""Bias correction of a model field against observations."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def moment_correction(
    model: DataFrame, calibration: DataFrame, observed: DataFrame,
    by: Sequence[str] = ("cell", "month", "hour"), value: str = "value",
) -> DataFrame:
    """Move the model's mean and spread to the observed ones, group by group.

    ``calibration`` is the model over the observed period; ``model`` may be another period. Adds
    ``corrected``: NULL where a group has no statistics, and a plain shift where the model does
    not vary. The statistics are one small row per group; a hot group of the model is split by
    adaptive execution when the join shuffles.
    """
    sides = calibration.selectExpr(*by, f"{value} AS _m").unionByName(
        observed.selectExpr(*by, f"{value} AS _o"), allowMissingColumns=True
    )
    moments = sides.groupBy(*by).agg(
        F.expr("avg(_m) AS _mm"), F.expr("stddev_samp(_m) AS _ms"),
        F.expr("avg(_o) AS _om"), F.expr("stddev_samp(_o) AS _os"),
    )
    corrected = f"({value} - _mm) * coalesce(try_divide(_os, _ms), 1D) + _om AS corrected"
    return model.join(moments, list(by), "left").selectExpr(*model.columns, corrected)


def _roots(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Square root and inverse square root of a symmetric matrix, tiny eigenvalues floored."""
    values, vectors = np.linalg.eigh((matrix + matrix.T) / 2)
    values = np.maximum(values, 1e-9)
    return (vectors * np.sqrt(values)) @ vectors.T, (vectors / np.sqrt(values)) @ vectors.T


def _micros(df: DataFrame) -> Column:
    """Time as whole microseconds; times without zone are not moved into one."""
    if dict(df.dtypes)["time"] == "timestamp":
        return F.unix_micros("time")
    return F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', time)")


def _neighbours(df: DataFrame, names: list[str], by: list[str], step: int, span: int) -> DataFrame:
    """One row per complete time: its chunk, values _x, and _prev, the values of the row before where
    that is one step earlier. _opens marks the first row of a chunk.

    A chunk covers ``span`` microseconds of a cell. Rows that a later chunk may look back on are sent
    there as well, so no task needs a cell's whole series.
    """
    merged = df.groupBy(*by, "time").agg(*[F.avg(v).cast("double").alias(v) for v in names])
    at = lambda t: F.floor(t / F.lit(span))
    rows = (
        merged.dropna(subset=[*names, "time"])
        .select(*by, "time", _micros(merged).alias("_t"), F.array(*names).alias("_x"))
        .withColumn("_chunk", F.explode(F.sequence(at(F.col("_t")), at(F.col("_t") + F.lit(step)))))
        .withColumn("_own", F.col("_chunk") == at(F.col("_t")))
    )
    order = Window.partitionBy(*by, "_chunk").orderBy("_t")
    near = F.col("_t") - F.lag("_t").over(order) == step
    return (
        rows.withColumns(
            {
                "_prev": F.when(near, F.lag("_x").over(order)),
                "_opens": ~F.coalesce(F.lag("_own").over(order), F.lit(False)),
            }
        )
        .where("_own")
        .drop("_own")
    )


def _moments(rows: DataFrame, k: int, by: list[str]) -> DataFrame:
    """Per cell means, spreads, and the dependence of the standardized values at one time (m0) and over
    one step (m1), in one aggregation. Cells with too few rows are left out."""
    x, prev = [F.col("_x")[i] for i in range(k)], [F.col("_prev")[i] for i in range(k)]
    after = [F.when(F.col("_prev").isNotNull(), c) for c in x]
    pairs = [(i, j) for i in range(k) for j in range(k)]
    sums = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count("_prev").alias("_pairs"),
        F.array(*[F.avg(c) for c in x]).alias("mean"),
        F.array(*[F.stddev_samp(c) for c in x]).alias("std"),
        F.array(*[F.covar_samp(x[i], x[j]) for i, j in pairs]).alias("c0"),
        F.array(*[F.covar_pop(after[i], prev[j]) for i, j in pairs]).alias("c1"),
        F.array(*[F.avg(c) for c in after]).alias("mean_after"),
        F.array(*[F.avg(c) for c in prev]).alias("mean_before"),
    ).where("_n >= 3 and _pairs >= 2")
    sums = sums.withColumn("std", F.transform("std", lambda s: F.when(s > 0, s).otherwise(1.0)))
    spread = lambda i, j: F.col("std")[i] * F.col("std")[j]
    off = lambda c, i: F.col(c)[i] - F.col("mean")[i]
    return sums.select(
        *by, "mean", "std",
        F.array(*[F.col("c0")[i * k + j] / spread(i, j) for i, j in pairs]).alias("m0"),
        F.array(
            *[
                (F.col("c1")[i * k + j] + off("mean_after", i) * off("mean_before", j)) / spread(i, j)
                for i, j in pairs
            ]
        ).alias("m1"),
    )


def _steps(k: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Per cell the matrices of the recursion on standardized values z, row by row:

    out[t] = again out[t-1] + new z[t] - old z[t-1], and out[t] = first z[t] where a run begins.
    """

    def run(cells: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in cells:
            made = []
            for row in df.itertuples(index=False):
                g0, g1, h0, h1 = (
                    np.asarray(m, float).reshape(k, k) for m in (row.m0, row.m1, row.want_m0, row.want_m1)
                )
                f, c = g1 @ np.linalg.pinv(g0), h1 @ np.linalg.pinv(h0)
                new = _roots(h0 - c @ h1.T)[0] @ _roots(g0 - f @ g1.T)[1]
                first = _roots(h0)[0] @ _roots(g0)[1]
                made.append([m.ravel().tolist() for m in (c, new, new @ f, first)])
            out = df.drop(columns=["m0", "m1", "want_m0", "want_m1"])
            out[["again", "new", "old", "first"]] = pd.DataFrame(made, index=df.index, columns=range(4))
            yield out

    return run


def _prefixes(again: np.ndarray, shocks: np.ndarray, follows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The affine map of each row from what entered its chunk: matrices m and vectors v, such that
    out[t] = m[t] entered + v[t]. Maps are composed by doubling, all rows at once."""
    m = np.where(follows[:, None, None], again, 0.0)
    v = shocks.copy()
    d = 1
    while d < len(v):
        v[d:] = v[d:] + np.einsum("tij,tj->ti", m[d:], v[:-d])
        m[d:] = np.einsum("tij,tjk->tik", m[d:], m[:-d])
        d *= 2
    return m, v


def _chunk_maps(df: pd.DataFrame, k: int) -> tuple[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray]:
    """A chunk in time order, its rows' maps, and its parameters: again, spreads and means."""
    df = df.sort_values("_t")
    fixed = np.asarray(df["_fixed"].iloc[0], float)
    m, v = _prefixes(fixed[: k * k].reshape(k, k), np.stack(df["_shock"].to_numpy()), df["_follows"].to_numpy(bool))
    return df, m, v, fixed


def multivariate_correction(
    model: DataFrame, observed: DataFrame, variables: Sequence[str],
    by: Sequence[str] = ("cell",), step: str = "6 hours", calibration: DataFrame | None = None,
    chunk: int = 4096,
) -> DataFrame:
    """Correct several variables of a cell together, with their lag-0 and lag-1 dependence.

    All fields have ``by``, ``time`` and a column per variable. The series of a cell is
    standardized, freed of the model's auto- and cross-dependence, given the observed one by a
    first-order recursion, and brought to the observed mean and spread. The model's statistics are
    those of ``calibration``, the model over the observed period, by default of ``model`` itself.
    Only rows one ``step`` apart count as neighbours, for the statistics and for the recursion.

    The result has every row of ``model`` with a column ``corrected_<variable>`` each: the
    correction of the mean of the rows at its time, NULL at times that lack a variable and in cells
    with fewer than three complete rows or two neighbours on a side.

    No task holds a cell's series. The statistics are one aggregation. The recursion is a chain of
    affine maps, so chunks of ``chunk`` steps are composed on their own; one small row per chunk then
    carries the value from chunk to chunk, and each chunk is finished from what entered it.
    """
    names, keys = list(variables), list(by)
    k, ticks = len(names), pd.Timedelta(step).value // 1000
    span = ticks * chunk
    rows = _neighbours(model, names, keys, ticks, span)
    own = rows if calibration is None else _neighbours(calibration, names, keys, ticks, span)
    want = _moments(_neighbours(observed, names, keys, ticks, span), k, keys)
    want = want.select(*keys, *[F.col(c).alias(f"want_{c}") for c in ("mean", "std", "m0", "m1")])
    types = {f.name: f.dataType.simpleString() for f in model.schema}
    key_types = [f"{c} {types[c]}" for c in keys]
    lists = ("mean", "std", "want_mean", "want_std", "again", "new", "old", "first")
    steps = _moments(own, k, keys).join(want, keys).mapInPandas(
        _steps(k), ", ".join(key_types + [f"{c} array<double>" for c in lists])
    )

    def standard(column: str, i: int) -> Column:
        return (F.col(column)[i] - F.col("mean")[i]) / F.col("std")[i]

    def applied(matrix: str, column: str, i: int) -> Column:
        return reduce(Column.__add__, [F.col(matrix)[i * k + j] * standard(column, j) for j in range(k)])

    shocks = F.array(
        *[
            F.when(F.col("_prev").isNull(), applied("first", "_x", i)).otherwise(
                applied("new", "_x", i) - applied("old", "_prev", i)
            )
            for i in range(k)
        ]
    )
    # what is the same for all rows of a cell travels on the first row of a chunk only
    ready = rows.join(steps, keys).select(
        *keys, "_chunk", "_t", "time", shocks.alias("_shock"), F.col("_prev").isNotNull().alias("_follows"),
        F.when(F.col("_opens"), F.concat("again", "want_std", "want_mean")).alias("_fixed"),
    )

    def tail(df: pd.DataFrame) -> pd.DataFrame:
        df, m, v, _ = _chunk_maps(df, k)
        return df[[*keys, "_chunk"]].iloc[:1].assign(m=[m[-1].ravel().tolist()], v=[v[-1].tolist()])

    def entering(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values("_chunk")
        value, entered = np.zeros(k), []
        for m, v in zip(df["m"], df["v"], strict=True):
            entered.append(value.tolist())
            value = np.asarray(m).reshape(k, k) @ value + np.asarray(v)
        return df[[*keys, "_chunk"]].assign(entered=entered)

    corrected = [f"corrected_{v}" for v in names]

    def finish(df: pd.DataFrame, entered: pd.DataFrame) -> pd.DataFrame:
        df, m, v, fixed = _chunk_maps(df, k)
        std, mean = fixed[k * k : k * k + k], fixed[k * k + k :]
        out = df[[*keys, "time"]].copy()
        out[corrected] = (m @ np.asarray(entered["entered"].iloc[0], float) + v) * std + mean
        return out

    chunked = ", ".join([*key_types, "_chunk long"])
    tails = ready.groupBy(*keys, "_chunk").applyInPandas(tail, f"{chunked}, m array<double>, v array<double>")
    entered = tails.groupBy(*keys).applyInPandas(entering, f"{chunked}, entered array<double>")
    done = (
        ready.groupBy(*keys, "_chunk")
        .cogroup(entered.groupBy(*keys, "_chunk"))
        .applyInPandas(
            finish, ", ".join([*key_types, f"time {types['time']}"] + [f"{c} double" for c in corrected])
        )
    )
    return model.join(done, [*keys, "time"], "left").select(*model.columns, *corrected)
