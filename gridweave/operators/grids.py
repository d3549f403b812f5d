"""Axes, cell bounds and grids.

A *grid* is a DataFrame (dst_id, lat, lon), one row per cell; it may be any list of points.
The *axes* of a rectilinear field are one row with two sorted arrays, made by one aggregation
whose map-side partial result is never longer than the axes. Work on axes is work on hundreds
or thousands of numbers, whatever the size of the field.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridweave.functions.coords import cell_id, clip_latitude, degree_key, wrap_longitude


def scan_grid(field: DataFrame) -> DataFrame:
    """Distinct cells of a field; longitudes stay as they are written, for box filters."""
    cells = field.selectExpr(
        f"{cell_id('lat', 'lon')} AS dst_id", f"{clip_latitude('lat')} AS lat", "lon"
    )
    return cells.where("dst_id IS NOT NULL").groupBy("dst_id").agg(
        F.expr("min(lat) AS lat"), F.expr("min(lon) AS lon")
    )


def grid_axes(field: DataFrame, *others: str) -> DataFrame:
    """One row: sorted arrays ``lats`` and ``lons`` of a rectilinear field or grid, and other
    aggregates with their names."""
    sets = field.selectExpr(
        f"array_sort(collect_set({clip_latitude('lat')})) AS lats",
        f"array_sort(collect_set({wrap_longitude('lon')})) AS lons",
        *others,
    )
    names = [c for c in sets.columns if c not in ("lats", "lons")]
    return sets.selectExpr(_distinct_values("lats"), _distinct_values("lons"), *names)


def _distinct_values(a: str) -> str:
    """Sorted axis without values that differ by less than one id step."""
    same = f"{degree_key('x')} = {degree_key(f'get({a}, i - 1)')}"
    return f"filter({a}, (x, i) -> i = 0 OR NOT ({same})) AS {a}"


def known_axes(field: DataFrame) -> DataFrame:
    """The same row, kept: latitudes and longitudes are used apart, the field is read once.

    Weights by axes need a rectilinear field: one whose cells are the product of its axes. Cells may
    be missing, as under a mask, but where less than half of the product is there, as with scattered
    points, using the axes is an error.
    """
    cells = scan_grid(field)
    counted = grid_axes(cells, "count(*) AS n")
    wrong = "not a rectilinear grid: its cells are less than half of the product of its axes"
    return counted.selectExpr(
        f"""CASE WHEN 2 * n >= size(lats) * size(lons) THEN lats
            ELSE CAST(raise_error('{wrong}') AS ARRAY<DOUBLE>) END AS lats""",
        "lons",
    ).persist()


def axis_segments(axes: DataFrame, name: str, periodic: bool = False) -> DataFrame:
    """Successive axis values as intervals (x0, x1) with the value before and after them.

    Columns x_prev, x0, x1, x_next and ``first``. A periodic axis also has the interval across
    the seam, at both of its places: its far ends lie outside [0, 360).
    """
    seam = f"concat(array(element_at({name}, -1) - 360D), {name}, array({name}[0] + 360D))"
    rows = axes.selectExpr(f"{seam if periodic else name} AS a").selectExpr(
        "a", "posexplode(a) AS (i, x0)"
    )
    return rows.selectExpr(
        "get(a, i - 1) AS x_prev", "x0", "get(a, i + 1) AS x1", "get(a, i + 2) AS x_next",
        "i = 0 AS first",
    ).where("x1 IS NOT NULL")


def axis_bounds(axes: DataFrame, name: str) -> DataFrame:
    """Cell bounds (x, lo, hi) around axis values.

    Bounds are midpoints; the outer ones mirror the half step on the other side. Latitudes are
    clamped to the poles. Longitude bounds may pass 0 or 360. A single value spans the circle or
    the hemispheres.
    """
    rows = axes.selectExpr(f"{name} AS a", f"posexplode({name}) AS (i, x)").selectExpr(
        "x", "get(a, i - 1) AS p", "get(a, i + 1) AS n"
    )
    whole = "90D" if name == "lats" else "180D"
    lo = f"x - coalesce((x - coalesce(p, x + x - n)) / 2, {whole})"
    hi = f"x + coalesce((coalesce(n, x + x - p) - x) / 2, {whole})"
    if name == "lats":
        lo, hi = f"greatest({lo}, -90D)", f"least({hi}, 90D)"
    return rows.selectExpr("x", f"{lo} AS lo", f"{hi} AS hi")


def split_at_seam(bounds: DataFrame) -> DataFrame:
    """Longitude bounds as pieces inside [0, 360]; a cell across the seam gives two pieces."""
    pieces = (
        "inline(array("
        "named_struct('lo', greatest(lo, 0D), 'hi', least(hi, 360D)),"
        "named_struct('lo', lo + 360D, 'hi', 360D),"
        "named_struct('lo', 0D, 'hi', hi - 360D)))"
    )
    return bounds.selectExpr("x", pieces).where("lo < hi")


def bins(lo: str, hi: str) -> str:
    """Numbers of the one-degree bins an interval touches, for joining ranges by equality."""
    return f"explode(sequence(floor({lo}), floor({hi}))) AS _bin"
