"""Evaluation statistics of fields over time.

Every statistic is an aggregation with map-side partial results, or pairs rows by their
coordinates including time; no series is gathered in one place, so one cell may hold any share
of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_time_keys(df: DataFrame) -> DataFrame:
    """Month and hour of day as grouping columns."""
    return df.withColumns({"month": F.month("time"), "hour": F.hour("time")})


def climatology(
    df: DataFrame, by: Sequence[str] = ("cell", "month", "hour"), value: str = "value"
) -> DataFrame:
    """Mean, standard deviation and number of values per group."""
    return df.groupBy(*by).agg(
        F.expr(f"avg({value}) AS mean"),
        F.expr(f"stddev_samp({value}) AS std"),
        F.expr(f"count({value}) AS n"),
    )


def lag1_autocorrelation(
    df: DataFrame, step: str = "6 hours", by: Sequence[str] = ("cell",), value: str = "value"
) -> DataFrame:
    """Correlation of a regular series with itself one step earlier.

    Each value is also written one step later; grouping by time then pairs neighbours. A gap in
    the series gives no pair.
    """
    before = df.withColumn("time", F.expr(f"time + interval {step}"))
    return _correlated(_paired(df, before, [*by, "time"], value), by, "lag1")


def _correlated(pairs: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    both = pairs.where("_a IS NOT NULL AND _b IS NOT NULL")
    return both.groupBy(*by).agg(
        F.expr(f"corr(_a, _b) AS {name}"), F.expr("count(*) AS n")
    )


def _paired(left: DataFrame, right: DataFrame, on: Sequence[str], value: str) -> DataFrame:
    """Values of two fields at the same coordinates, as _a and _b; rows that share one are averaged."""
    both = left.selectExpr(*on, f"{value} AS _a").unionByName(
        right.selectExpr(*on, f"{value} AS _b"), allowMissingColumns=True
    )
    return both.groupBy(*on).agg(F.expr("avg(_a) AS _a"), F.expr("avg(_b) AS _b"))


def cross_correlation(
    left: DataFrame, right: DataFrame, by: Sequence[str] = ("cell",), value: str = "value"
) -> DataFrame:
    """Correlation of two variables over time per group; rows pair by ``by`` and time."""
    return _correlated(_paired(left, right, [*by, "time"], value), by, "correlation")


def all_pairs(
    df: DataFrame, variable: str = "var", by: Sequence[str] = ("cell",), value: str = "value"
) -> DataFrame:
    """Every two variables of one point (``by`` and time), as a, b, _a, _b with a < b by name.

    Values of one variable at a point are averaged first; a point's variables are few, and they are
    paired within its one row.
    """
    means = df.groupBy(*by, "time", variable).agg(F.expr(f"avg({value}) AS _v"))
    points = means.groupBy(*by, "time").agg(
        F.expr(f"array_sort(collect_list(named_struct('var', {variable}, 'v', _v))) AS _s")
    )
    left = points.selectExpr(*by, "time", "_s", "posexplode(_s) AS (_i, _x)")
    pairs = left.selectExpr(*by, "time", "_x", "explode(slice(_s, _i + 2, size(_s))) AS _y")
    return pairs.selectExpr(*by, "time", "_x.var AS a", "_y.var AS b", "_x.v AS _a", "_y.v AS _b")


def cross_correlations(df: DataFrame, by: Sequence[str] = ("cell",), value: str = "value") -> DataFrame:
    """Correlation over time of every two variables, per group."""
    return _correlated(all_pairs(df, "var", by, value), [*by, "a", "b"], "correlation")


def mean_absolute_biases(
    df: DataFrame, by: Sequence[str] = ("cell",), value: str = "value"
) -> DataFrame:
    """Mean absolute difference of every two variables, per group."""
    both = all_pairs(df, "var", by, value).where("_a IS NOT NULL AND _b IS NOT NULL")
    return both.groupBy(*by, "a", "b").agg(
        F.expr("avg(abs(_a - _b)) AS bias"), F.expr("count(*) AS n")
    )


def mean_absolute_bias(
    model: DataFrame, observed: DataFrame, by: Sequence[str] = ("cell",), value: str = "value"
) -> DataFrame:
    """Mean absolute difference between model and observation per group."""
    pairs = _paired(model, observed, [*by, "time"], value)
    both = pairs.where("_a IS NOT NULL AND _b IS NOT NULL")
    return both.groupBy(*by).agg(
        F.expr("avg(abs(_a - _b)) AS bias"), F.expr("count(*) AS n")
    )


def histogram(
    df: DataFrame, width: float, by: Sequence[str] = ("hour",), value: str = "value"
) -> DataFrame:
    """Number of values per bin of fixed width, labelled by the bin's lower end."""
    binned = df.where(f"{value} IS NOT NULL").selectExpr(
        *by, f"floor({value} / {float(width)}D) * {float(width)}D AS low"
    )
    return binned.groupBy(*by, "low").agg(F.expr("count(*) AS n"))


def quantiles(
    df: DataFrame, probabilities: Sequence[float], width: float,
    by: Sequence[str] = ("hour",), value: str = "value",
) -> DataFrame:
    """Exact quantiles (by, p, quantile) with linear interpolation between ranks.

    Equal values are counted first. Counts per bin of ``width`` tell which bins hold the wanted
    ranks, and only values of those bins are ranked, each bin on its own. So no group is ever
    sorted whole; ``width`` should give bins of at most some million distinct values.
    """
    keys = ", ".join(by)
    counted = (
        df.where(f"{value} IS NOT NULL")
        .groupBy(*by, F.col(value).alias("_v"))
        .agg(F.expr("count(*) AS _n"))
        .withColumn("_bin", F.expr(f"floor(_v / {float(width)}D)"))
    )
    per_bin = counted.groupBy(*by, "_bin").agg(F.expr("sum(_n) AS _n")).selectExpr(
        *by, "_bin", "_n",
        f"sum(_n) OVER (PARTITION BY {keys} ORDER BY _bin) AS _end",
        f"sum(_n) OVER (PARTITION BY {keys}) AS _total",
    )
    wanted = ", ".join(f"{float(p)}D" for p in probabilities)
    ranks = (
        per_bin.selectExpr("*", "_end - _n AS _start", f"explode(array({wanted})) AS p")
        .selectExpr("*", "p * (_total - 1) AS _at")
        .selectExpr("*", "explode(array_distinct(array(floor(_at), ceil(_at)))) AS _rank")
        .where("_rank >= _start AND _rank < _end")
        .selectExpr(*by, "_bin", "_start", "p", "_rank", "_at - floor(_at) AS _share", "_rank <= _at AS _low")
    )
    needed = ranks.select(*by, "_bin", "_start").distinct()
    placed = counted.join(needed, [*by, "_bin"]).selectExpr(
        *by, "_bin", "_v", "_n",
        f"_start + sum(_n) OVER (PARTITION BY {keys}, _bin ORDER BY _v) AS _upto",
    )
    hits = ranks.drop("_start").join(placed, [*by, "_bin"]).where(
        "_rank < _upto AND _rank >= _upto - _n"
    )
    ends = hits.groupBy(*by, "p").agg(
        F.expr("max(CASE WHEN _low THEN _v END) AS _a"),
        F.expr("max(CASE WHEN NOT _low THEN _v END) AS _b"),
        F.expr("max(_share) AS _share"),
    )
    return ends.selectExpr(
        *by, "p", "_a + (coalesce(_b, _a) - _a) * _share AS quantile"
    )


def drop_spin_up(df: DataFrame, years: int = 1) -> DataFrame:
    """Without the first years of the run, counted from its first time, which is one number."""
    first = df.agg(F.min("time")).scalar()
    return df.where(F.col("time") >= first + F.expr(f"make_ym_interval({int(years)})"))


def short_records(
    df: DataFrame, by: Sequence[str] = ("cell",), minimum_years: int = 31
) -> DataFrame:
    """Groups with fewer years of data than wanted, with their number of years."""
    years = df.select(*by, F.year("time").alias("_year")).distinct()
    return (
        years.groupBy(*by)
        .agg(F.count(F.lit(1)).alias("years"))
        .where(F.col("years") < minimum_years)
    )
