"""Vertical profiles: heights, interpolation, edges.

A *column* is the set of rows that share the ``columns`` keys, (time, dst_id) by default. Its
length is the number of model levels. All windows here are partitioned by the column, so
they share one exchange, and every window frame grows from the start, so a column costs its
length times the logarithm of it and no level is ever compared with all others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridweave.functions import physics
from gridweave.functions.coords import nan_to_null

COLUMNS = ("time", "dst_id")


def _column(columns: Sequence[str]) -> str:
    """PARTITION BY clause. The cell goes first: it tells rows apart better than the time, and
    sorting looks at the first key before it compares whole rows."""
    return f"PARTITION BY {', '.join(reversed(columns))}"


def _levels(*names: str) -> str:
    fields = ", ".join(f"'{n}', {n}" for n in ("lev_idx", *names))
    return f"array_sort(collect_list(named_struct({fields})))"


def pressure_levels(surface: DataFrame, coefficients: DataFrame, ps: str = "ps") -> DataFrame:
    """Pressure of every level over a surface-pressure field.

    The coefficients (lev_idx, ap, b) are one value per level. They reach the field as one array
    and each surface row is expanded into its levels.
    """
    levels = coefficients.selectExpr(_levels("ap", "b")).scalar()
    expanded = surface.select("*", F.inline(levels))
    p = physics.hybrid_pressure(F.col("ap"), F.col("b"), F.col(ps))
    return expanded.withColumn("p", p).drop("ap", "b")


def hybrid_heights(orography: DataFrame, coefficients: DataFrame, orog: str = "orog") -> DataFrame:
    """Height of every hybrid-height level over terrain; coefficients (lev_idx, a, b)."""
    levels = coefficients.selectExpr(_levels("a", "b")).scalar()
    expanded = orography.select("*", F.inline(levels))
    z = physics.hybrid_height(F.col("a"), F.col("b"), F.col(orog))
    return expanded.withColumn("zfull", z).drop("a", "b")


def hypsometric_heights(
    df: DataFrame, p: str = "p", t: str = "t", q: str | None = None,
    columns: Sequence[str] = COLUMNS, order: str = "lev_idx", out: str = "zfull",
) -> DataFrame:
    """Heights from pressure and temperature; the first level of a column is 0.

    ``order='lev_idx'`` follows the level index, so heights rise when index 0 is the bottom;
    ``order='pressure_desc'`` starts at the highest pressure. A layer with missing data adds
    nothing.
    """
    if order not in ("lev_idx", "pressure_desc"):
        raise ValueError(f"unknown order: {order}")
    by = "lev_idx" if order == "lev_idx" else f"{p} DESC"
    over = f"OVER ({_column(columns)} ORDER BY {by})"
    below = df.selectExpr("*", *[f"lag({c}) {over} AS _{c}" for c in (p, t, q) if c])
    layer = physics.layer_thickness(
        F.col(f"_{p}"), F.col(p), F.col(f"_{t}"), F.col(t),
        *((F.col(f"_{q}"), F.col(q)) if q else ()),
    )
    running = over.replace(")", " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    return below.withColumn("_dz", layer).selectExpr(
        *df.columns, f"sum(coalesce({nan_to_null('_dz')}, 0D)) {running} AS {out}"
    )


def adjust_edges(
    df: DataFrame, z: str = "z", columns: Sequence[str] = COLUMNS
) -> DataFrame:
    """One more level at each end of a column, continuing the outer differences.

    Levels are numbered anew: 0 for the added bottom, 1..n inside, n+1 for the added top.
    """
    over = f"OVER ({_column(columns)} ORDER BY lev_idx)"
    rows = df.selectExpr(
        *columns, f"{z} AS _z", f"row_number() {over} AS _i", f"lag({z}) {over} AS _below",
        f"lead({z}) {over} AS _above", f"lead(1) {over} IS NULL AS _top",
    )

    def level(i: str, height: str) -> str:
        return f"array(named_struct('lev_idx', {i}, '{z}', {height}))"

    own = level("_i", "_z")
    none = f"filter({own}, e -> false)"
    levels = f"""concat(
        CASE WHEN _i = 1 THEN {level('0', '_z - (_above - _z)')} ELSE {none} END, {own},
        CASE WHEN _top THEN {level('_i + 1', '_z + (_z - _below)')} ELSE {none} END)"""
    return rows.selectExpr(*columns, f"inline({levels})")


def vertical_interpolation(
    source: DataFrame, targets: DataFrame, value: str = "value", z: str = "z", x: str = "x",
    columns: Sequence[str] = COLUMNS, above: str = "null", missing: str = "break",
) -> DataFrame:
    """Values of each source column at the target heights of the same column.

    ``source``: columns, ``z``, ``value``. ``targets``: columns, ``lev_idx``, ``x`` and any other
    columns, which are kept. The result has the rows of ``targets`` with ``value`` added.

    Between levels the value is on the straight line; below the lowest level the lowest line goes
    on. ``above='null'`` gives NULL over the highest level, ``'extrapolate'`` lets the highest
    line go on. A column needs two levels; levels without height are left out. With
    ``missing='break'`` a level without value makes the lines to and from it NULL; with
    ``'bridge'`` it is left out, so that one line spans the gap and edges go on from what is there.

    Target heights that lack a key of ``columns`` (no time) belong to all source columns with the
    same remaining keys.
    """
    if above not in ("null", "extrapolate"):
        raise ValueError(f"unknown rule above the top: {above}")
    if missing not in ("break", "bridge"):
        raise ValueError(f"unknown rule for missing levels: {missing}")
    points = source.selectExpr(
        *columns, f"{number(z)} AS _h", f"{number(value)} AS _v", "true AS _level"
    ).where("_h IS NOT NULL" + (" AND _v IS NOT NULL" if missing == "bridge" else ""))
    carried = [c for c in targets.columns if c not in (*columns, x)]
    wanted = targets.selectExpr(
        *[c for c in columns if c in targets.columns], *carried, f"{number(x)} AS _h"
    )
    if set(columns) <= set(targets.columns):
        wanted = wanted.selectExpr("*", "false AS _level")
        # exchanged here, so that the structs made for the window below are not part of the rows
        merged = points.unionByName(wanted, allowMissingColumns=True).repartition(*reversed(columns))
    else:
        merged = _with_static_targets(points, wanted, columns, carried)

    # Levels and targets in one order by height, a target before a level of equal height: the
    # lines come from the levels next to the target, found by one pass over one sort.
    level = "CASE WHEN _level THEN named_struct('h', _h, 'v', _v) END"
    over = f"IGNORE NULLS OVER ({_column(columns)} ORDER BY _h, _level, _v)"
    near = [f"lag({level}, 1) {over} AS _a", f"lead({level}, 1) {over} AS _b", f"lead({level}, 2) {over} AS _c"]
    if above == "extrapolate":
        near.append(f"lag({level}, 2) {over} AS _z")
    beside = merged.selectExpr("*", *near).where("NOT _level")
    top = line("_h", "_z", "_a") if above == "extrapolate" else "CAST(NULL AS DOUBLE)"
    return beside.selectExpr(
        *columns, *[f"_h AS {c}" if c == x else c for c in targets.columns if c not in columns],
        f"""CASE WHEN _a IS NULL THEN {line('_h', '_b', '_c')}
                 WHEN _b IS NULL THEN {top} ELSE {line('_h', '_a', '_b')} END AS {value}""",
    )


def number(c: str) -> str:
    return nan_to_null(f"CAST({c} AS DOUBLE)")


def line(x: str, p: str, q: str) -> str:
    """Point x on the line through two levels; NULL when they have the same height."""
    return f"{p}.v + ({q}.v - {p}.v) * try_divide({x} - {p}.h, {q}.h - {p}.h)"


def _with_static_targets(
    points: DataFrame, wanted: DataFrame, columns: Sequence[str], carried: Sequence[str]
) -> DataFrame:
    """Levels of each column, its lowest row followed by the target rows of its cell."""
    shared = [c for c in columns if c in wanted.columns]
    fields = ", ".join(f"'{c}', {c}" for c in ("_h", *carried))
    lists = wanted.groupBy(*shared).agg(F.expr(f"collect_list(named_struct({fields})) AS _list"))
    over = f"OVER ({_column(columns)} ORDER BY _h, _v)"
    itself = "array(if(false, _list[0], NULL))"
    return (
        points.selectExpr("*", f"row_number() {over} AS _n")
        .join(lists, shared)
        .selectExpr(
            *columns, "_h", "_v",
            f"explode(if(_n = 1, concat({itself}, _list), {itself})) AS _w",
        )
        .selectExpr(
            *columns, *[f"_w.{c} AS {c}" for c in carried],
            "if(_w IS NULL, _h, _w._h) AS _h", "if(_w IS NULL, _v, NULL) AS _v",
            "_w IS NULL AS _level",
        )
    )
