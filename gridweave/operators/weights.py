"""Sparse regridding weights (dst_id, src_id, w, n_src).

The source must be rectilinear, so all weights are products of weights along the two axes.
``n_src`` is the number of weights of the target cell: a target is only known when all of its
source values are, and a source row that is absent can be noticed only by this count.

Ranges are joined by equality of one-degree bins plus the exact range test, never by a bare
range, so every join here is a hash join whose candidates lie within a degree or one cell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridweave.functions.coords import cell_id, clip_latitude, degree_key, wrap_longitude
from gridweave.operators.grids import (
    axis_bounds,
    axis_segments,
    bins,
    known_axes,
    scan_grid,
    split_at_seam,
)

METHODS = (
    "bilinear", "conservative", "conservative_normed", "nearest_s2d", "nearest_d2s", "patch",
)


def normalized(grid: DataFrame) -> DataFrame:
    """Grid with clamped latitudes and longitudes in [0, 360)."""
    return grid.selectExpr(
        "dst_id", f"{clip_latitude('lat')} AS lat", f"{wrap_longitude('lon')} AS lon"
    )


def _bracket(points: DataFrame, axes: DataFrame, coord: str, periodic: bool = False) -> DataFrame:
    """Add the segment that holds each point and the share ``f`` of its upper end, as a struct."""
    segments = axis_segments(axes, f"{coord}s", periodic).selectExpr(
        "x_prev", "x0", "x1", "x_next", "first", bins("x0", "x1")
    )
    near = points.withColumn("_bin", F.expr(f"floor({coord})")).join(segments, "_bin")
    inside = near.where(f"{coord} <= x1 AND ({coord} > x0 OR (first AND {coord} = x0))")
    return inside.selectExpr(
        *points.columns,
        f"""named_struct('x', {coord}, 'p', x_prev, 'a', x0, 'b', x1, 'n', x_next,
                         'f', ({coord} - x0) / (x1 - x0)) AS {coord}_seg""",
    )


def _bracketed(src_axes: DataFrame, grid: DataFrame, periodic: bool) -> DataFrame:
    return _bracket(_bracket(normalized(grid), src_axes, "lat"), src_axes, "lon", periodic)


def _nodes(*pairs: tuple[str, str]) -> str:
    """Axis nodes (x, w) without zero weights."""
    nodes = ", ".join(f"named_struct('x', {x}, 'w', {w})" for x, w in pairs)
    return f"filter(array({nodes}), e -> e.x IS NOT NULL AND e.w != 0)"


def _from_nodes(points: DataFrame, lat_nodes: str, lon_nodes: str) -> DataFrame:
    """All pairs of the two short node lists of a target cell, with the product of weights."""
    pairs = f"""flatten(transform(a, p -> transform(b, q ->
        named_struct('src_id', {cell_id('p.x', 'q.x')}, 'w', p.w * q.w))))"""
    return (
        points.selectExpr("dst_id", f"{lat_nodes} AS a", f"{lon_nodes} AS b")
        .selectExpr("dst_id", "size(a) * size(b) AS n_src", f"inline({pairs})")
        .select("dst_id", "src_id", "w", "n_src")
    )


def weights_bilinear(src_axes: DataFrame, grid: DataFrame, periodic: bool = False) -> DataFrame:
    """Four-corner weights. Targets outside the source hull get none."""

    def nodes(s: str) -> str:
        return _nodes((f"{s}.a", f"1 - {s}.f"), (f"{s}.b", f"{s}.f"))

    points = _bracketed(src_axes, grid, periodic)
    return _from_nodes(points, nodes("lat_seg"), nodes("lon_seg"))


def _parabola(x: str, at: str, other: str, another: str) -> str:
    """Weight at x of one of the three nodes of a parabola."""
    return f"({x} - {other}) * ({x} - {another}) / (({at} - {other}) * ({at} - {another}))"


def weights_patch(src_axes: DataFrame, grid: DataFrame, periodic: bool = False) -> DataFrame:
    """Patch recovery: a parabola around each end of the interval, blended linearly.

    Next to the edge only the inner parabola exists and is used alone; with two axis values the
    result is bilinear.
    """

    def nodes(s: str) -> str:
        x, p, a, b, n, f = (f"{s}.{c}" for c in ("x", "p", "a", "b", "n", "f"))
        upper = f"CASE WHEN {n} IS NULL THEN 0D WHEN {p} IS NULL THEN 1D ELSE {f} END"
        straight = f"{p} IS NULL AND {n} IS NULL"

        def low(at: str, other: str, another: str) -> str:
            return f"coalesce((1 - {upper}) * {_parabola(x, at, other, another)}, 0D)"

        def high(at: str, other: str, another: str) -> str:
            return f"coalesce({upper} * {_parabola(x, at, other, another)}, 0D)"

        def inner(plain: str, *terms: str) -> str:
            return f"CASE WHEN {straight} THEN {plain} ELSE {' + '.join(terms)} END"

        return _nodes(
            (p, low(p, a, b)),
            (a, inner(f"1 - {f}", low(a, p, b), high(a, b, n))),
            (b, inner(f, low(b, p, a), high(b, a, n))),
            (n, high(n, a, b)),
        )

    points = _bracketed(src_axes, grid, periodic)
    return _from_nodes(points, nodes("lat_seg"), nodes("lon_seg"))


def _overlaps(src: DataFrame, dst: DataFrame) -> DataFrame:
    """Pairs of source and target intervals that overlap, with the overlap's ends.

    Both sides are listed in every bin they touch; a pair is taken only in the first bin the two
    share, so it appears once without a distinct.
    """
    s = src.selectExpr("x AS src", "lo AS slo", "hi AS shi", bins("lo", "hi"))
    d = dst.selectExpr("x AS dst", "lo AS dlo", "hi AS dhi", bins("lo", "hi"))
    return (
        s.join(d, "_bin")
        .where("slo < dhi AND dlo < shi AND _bin = greatest(floor(slo), floor(dlo))")
        .selectExpr("dst", "src", "greatest(slo, dlo) AS lo", "least(shi, dhi) AS hi")
    )


def _overlap_nodes(src: DataFrame, dst: DataFrame, measure: str, normed: bool) -> DataFrame:
    """Rows (dst, nodes): per target value its source values and the covered shares.

    ``measure`` gives the size of an interval from its ends ``lo`` and ``hi``.
    """
    total = dst.groupBy(F.col("x").alias("dst")).agg(F.expr(f"sum({measure}) AS total"))
    parts = _overlaps(src, dst).groupBy("dst", "src").agg(F.expr(f"sum({measure}) AS part"))
    shares = parts.join(total, "dst").selectExpr("dst", "src", "part / total AS w").where("w > 0")
    grouped = shares.groupBy("dst").agg(
        F.expr("array_sort(collect_list(named_struct('x', src, 'w', w))) AS nodes"),
        F.expr("sum(w) AS covered"),
    )
    if not normed:
        return grouped.select("dst", "nodes")
    return grouped.selectExpr(
        "dst", "transform(nodes, e -> named_struct('x', e.x, 'w', e.w / covered)) AS nodes"
    )


def weights_conservative(
    src_axes: DataFrame, dst_axes: DataFrame, grid: DataFrame, norm: str = "dst"
) -> DataFrame:
    """Area-overlap weights between rectilinear grids.

    ``norm='dst'`` divides by the target cell's area, ``'frac'`` by its covered area. ``grid``
    lists the target cells wanted; bounds come from the whole target axes, so a region cut out
    of the target keeps its cell sizes.
    """
    if norm not in ("dst", "frac"):
        raise ValueError(f"unknown norm: {norm}")
    lat = _overlap_nodes(
        axis_bounds(src_axes, "lats"), axis_bounds(dst_axes, "lats"),
        "sin(radians(hi)) - sin(radians(lo))", norm == "frac",
    )
    lon = _overlap_nodes(
        split_at_seam(axis_bounds(src_axes, "lons")), split_at_seam(axis_bounds(dst_axes, "lons")),
        "hi - lo", norm == "frac",
    )
    cells = (
        normalized(grid)
        .selectExpr("dst_id", f"{degree_key('lat')} AS _lat", f"{degree_key('lon')} AS _lon")
        .join(lat.selectExpr(f"{degree_key('dst')} AS _lat", "nodes AS lat_nodes"), "_lat")
        .join(lon.selectExpr(f"{degree_key('dst')} AS _lon", "nodes AS lon_nodes"), "_lon")
    )
    return _from_nodes(cells, "lat_nodes", "lon_nodes")


def _nearest_lon(points: DataFrame, axes: DataFrame) -> DataFrame:
    """Add the nearest longitude of the axis as ``near_lon``.

    Every axis value has a catchment (lo, hi] up to the midpoints, open at the ends. Longitudes
    also have their values one turn away, so the nearest one is found across the seam.
    """
    turn = "array(element_at(lons, -1) - 360D), lons, array(lons[0] + 360D)"
    catchments = (
        axes.selectExpr(f"array_distinct(concat({turn})) AS a").selectExpr("a", "posexplode(a) AS (i, x)")
        .selectExpr(
            "x AS near_lon",
            "coalesce(greatest((x + get(a, i - 1)) / 2, -1D), -1D) AS lo",
            "coalesce(least((x + get(a, i + 1)) / 2, 361D), 361D) AS hi",
        )
        .where("lo < hi")
        .selectExpr("*", bins("lo", "hi"))
    )
    return (
        points.withColumn("_bin", F.expr("floor(lon)"))
        .join(catchments, "_bin")
        .where("lon > lo AND lon <= hi")
        .drop("_bin", "lo", "hi")
    )


def weights_nearest(src_axes: DataFrame, grid: DataFrame) -> DataFrame:
    """Every target takes the source value at the smallest great-circle distance.

    In any row of the source the nearest longitude is nearest on the sphere too, so a target
    compares one cell per row. Ties go to the smaller latitude, then the nearer and the smaller
    longitude.
    """
    far = (
        "pow(sin(radians(a - lat) / 2), 2) + cos(radians(lat)) * cos(radians(a))"
        " * pow(sin(radians(near_lon - lon) / 2), 2)"
    )
    rows = f"transform(_lats, a -> named_struct('d', round({far}, 12), 'lat', a))"
    points = _nearest_lon(normalized(grid), src_axes).withColumn("_lats", src_axes.select("lats").scalar())
    points = points.withColumn("near_lat", F.expr(f"array_min({rows}).lat"))
    return points.selectExpr(
        "dst_id", f"{cell_id('near_lat', 'near_lon')} AS src_id", "1D AS w", "1 AS n_src"
    )


def weights_nearest_reverse(src_grid: DataFrame, dst_axes: DataFrame) -> DataFrame:
    """Every source cell goes to its nearest target; several are summed, some targets get none.

    ``src_grid`` has the same columns as a target grid; its ``dst_id`` is the source cell.
    """
    sent = weights_nearest(dst_axes, src_grid).selectExpr(
        "src_id AS dst_id", "dst_id AS src_id", "w"
    )
    counts = sent.groupBy("dst_id").agg(F.expr("CAST(count(*) AS INT) AS n_src"))
    return sent.join(counts, "dst_id").select("dst_id", "src_id", "w", "n_src")


def build_weights(
    method: str, source: DataFrame, target: DataFrame, box_grid: DataFrame | None = None,
    periodic: bool = False,
) -> DataFrame:
    """Weights between the grids of two fields.

    ``box_grid`` restricts the target cells before any weight is made, so source cells that only
    serve other cells never leave the scan stage.
    """
    if method not in METHODS:
        raise ValueError(f"unknown method: {method}")
    grid = box_grid if box_grid is not None else scan_grid(target)
    if method == "nearest_d2s":
        reverse = weights_nearest_reverse(scan_grid(source), known_axes(target))
        return reverse.join(grid.select("dst_id"), "dst_id", "left_semi")
    axes = known_axes(source)
    if method == "bilinear":
        return weights_bilinear(axes, grid, periodic)
    if method == "patch":
        return weights_patch(axes, grid, periodic)
    if method == "nearest_s2d":
        return weights_nearest(axes, grid)
    norm = "frac" if method == "conservative_normed" else "dst"
    return weights_conservative(axes, known_axes(target), grid, norm)
