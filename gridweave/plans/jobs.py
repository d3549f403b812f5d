"""The interpolation jobs: surface field, first 3-D version, configured 3-D version."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.functions.coords import cell_id
from gridweave.functions.physics import geopotential_height
from gridweave.operators.align import require_nonempty, stack_variables, unmatched
from gridweave.operators.coordinates import (
    build_output,
    clip_latitude,
    map_variable,
    regrid_method,
    with_coordinates,
)
from gridweave.operators.grids import scan_grid
from gridweave.operators.regrid import at_every_step, merge_weights, regrid, regrid_streams
from gridweave.operators.resample import resample_mean
from gridweave.operators.selection import (
    SYNOPTIC_HOURS,
    Box,
    filter_bbox,
    filter_synoptic,
    filter_years,
)
from gridweave.operators.vertical import vertical_interpolation
from gridweave.operators.weights import build_weights
from gridweave.plans.heights import regrid_heights, stored_heights, with_cells
from gridweave.sources.catalogue import Catalogue, catalogue
from gridweave.sources.fields import (
    available_months,
    discover_months,
    scan_field,
)
from gridweave.sources.store import (
    attach_attrs,
    attrs_table,
    grid_fingerprint,
    load_or_make_weights,
    read_attrs,
    write_attrs,
    write_field,
)

WIND = ("ua", "va")
POINT = ("time", "lev_idx", "lat", "lon")


def combine_source(values: DataFrame, geopotential: DataFrame) -> DataFrame:
    """Variable and geopotential as columns ``value`` and ``geopotential`` of one table."""
    return stack_variables({"value": values, "geopotential": geopotential}, POINT)


def regrid_surface(
    source: DataFrame, target: DataFrame, method: str = "bilinear",
    weights: DataFrame | None = None, periodic: bool = False,
) -> DataFrame:
    """Surface field (time, lat, lon, value) on the target's grid, at all its times.

    Every target cell has a row at every time, NULL where the source does not reach.
    """
    source = clip_latitude(source)
    grid = scan_grid(target)
    if weights is None:
        weights = build_weights(method, source, target, grid, periodic)
    return regrid(source, weights, ["value"], ["time"], coordinates=True, dense_grid=grid)


def interpolate_to_levels(
    source: DataFrame, target: DataFrame, heights: DataFrame, method: str = "bilinear",
    weights: DataFrame | None = None, every: str = "6 hours",
) -> DataFrame:
    """First version: 6-hourly means, one method for both fields, lines go on at both ends.

    ``source`` has time, lev_idx, lat, lon, value, geopotential. ``heights`` has dst_id,
    lev_idx, zfull. Returns time, dst_id, lev_idx, value: a row for every step of the source and
    every point of ``heights``, NULL where the value is unknown.
    """
    source = clip_latitude(source)
    if weights is None:
        weights = build_weights(method, source, target)
    means = resample_mean(source, every, ("lev_idx", "lat", "lon"), ("value", "geopotential"))
    moved = regrid(means, weights, ["value", "geopotential"])
    profiles = moved.withColumn("z", geopotential_height(F.col("geopotential")))
    # the steps of the means without making the means a second time
    steps = source.selectExpr(f"window(time, '{every}').start AS time").where("time IS NOT NULL").distinct()
    wanted = at_every_step(steps, heights.select("dst_id", "lev_idx", "zfull"))
    return vertical_interpolation(profiles, wanted, x="zfull", above="extrapolate").drop("zfull")


def interpolate_and_fill(
    source: DataFrame, target: DataFrame, heights: DataFrame | None, method: str = "bilinear",
    box: Box | None = None, years: tuple[int, int] | None = None,
    weights: dict[str, DataFrame] | None = None, periodic: bool = False, strict: bool = True,
    geopotential: DataFrame | None = None, geopotential_weights: DataFrame | None = None,
    missing: str = "break",
) -> DataFrame:
    """Configured version: synoptic hours, regridding, heights, and the target's own values above.

    ``source`` has time, lev_idx, lat, lon, value, and geopotential (see ``combine_source``) unless
    ``geopotential`` is given as a field of its own, which may be on another grid; it is always
    moved bilinearly, with weights of its own. ``target`` has time, lev_idx, lat, lon, value;
    ``heights`` has dst_id, lev_idx, zfull and maybe time, or is None when ``target`` has the column
    zfull itself. The result has the rows of the target inside the box and period, at the target's
    own coordinates: time, dst_id, lev_idx, lat, lon, value.

    ``strict`` raises when source and target do not have the same times, and when no cell of an
    input meets its weights; without it such rows take the target's own values. ``missing`` is
    the rule for levels without value, see ``vertical_interpolation``.

    Two exchanges carry data: the regridding sums, and the columns. The fill value travels with
    the target height, so filling needs no join.
    """
    source, target = filter_synoptic(clip_latitude(source)), clip_latitude(target)
    if geopotential is not None:
        geopotential = filter_synoptic(clip_latitude(geopotential))
    if years is not None:
        source, target = filter_years(source, *years), filter_years(target, *years)
        geopotential = filter_years(geopotential, *years) if geopotential is not None else None
    inside = filter_bbox(target, box) if box is not None else target
    inputs = {"variable": source} | ({"geopotential": geopotential} if geopotential is not None else {})
    if strict:
        for name, df in inputs.items():
            times = [x.select("time").distinct() for x in (df, target)]
            if not unmatched(*times, ["time"]).isEmpty():
                raise ValueError(f"{name} and target do not have the same times")
    grid = scan_grid(inside)
    if weights is None:
        kinds = {method} if geopotential is not None else {"bilinear", method}
        weights = {m: build_weights(m, source, target, grid, periodic) for m in kinds}
    if geopotential is not None and geopotential_weights is None:
        geopotential_weights = build_weights("bilinear", geopotential, target, grid, periodic)
    if strict:
        used = {"variable": weights[method]}
        if geopotential is not None:
            used["geopotential"] = geopotential_weights
        for name, w in used.items():
            _require_common_cell(inputs[name], w, name)
    if geopotential is not None:
        moved = regrid_streams(
            [
                (source, weights[method], ["value"]),
                (geopotential, geopotential_weights, ["geopotential"]),
            ]
        )
    elif method == "bilinear":
        moved = regrid(source, weights["bilinear"], ["value", "geopotential"])
    else:
        moved = regrid(
            source, merge_weights(weights), {"value": method, "geopotential": "bilinear"}
        )
    profiles = moved.withColumn("z", geopotential_height(F.col("geopotential")))
    own = inside.withColumn("dst_id", F.expr(cell_id("lat", "lon")))
    carried = [c for c in ("lev",) if c in own.columns]
    points = own.selectExpr("dst_id", *POINT, *carried, "value AS own", *(["zfull"] if heights is None else []))
    if heights is not None:
        points = _with_heights(points, heights)
    lines = vertical_interpolation(profiles, points, x="zfull", missing=missing)
    return lines.selectExpr(
        "time", "dst_id", "lev_idx", *carried, "lat", "lon", "coalesce(value, own) AS value"
    )


def interpolate_variables(
    sources: Mapping[str, tuple[DataFrame, DataFrame]], geopotential: DataFrame,
    geopotential_weights: DataFrame, target: DataFrame, heights: DataFrame, box: Box | None = None,
    strict: bool = True, missing: str = "break",
) -> DataFrame:
    """The configured version for several variables of one target grid, in one plan.

    ``sources`` has a field (time, lev_idx, lat, lon, value) and its weights per variable, each on its
    own grid and with its own method. ``target`` has the column ``var`` besides those of a field. The
    result has the rows of the target inside the box, with ``var``: see ``interpolate_and_fill``.

    All variables and the geopotential are regridded by one aggregation: the geopotential is read,
    weighted and summed once, however many variables need it. One exchange brings the columns of all
    variables together. ``strict`` makes two jobs, whatever the number of variables.
    """
    names = list(sources)
    fields = {v: filter_synoptic(clip_latitude(df)) for v, (df, _) in sources.items()}
    geopotential, target = filter_synoptic(clip_latitude(geopotential)), clip_latitude(target)
    weights = {v: w for v, (_, w) in sources.items()}
    if strict:
        _require_same_times(fields, geopotential, target)
        _require_common_cells(
            {**{v: (fields[v], weights[v]) for v in names}, "geopotential": (geopotential, geopotential_weights)}
        )
    # numbered columns: names of variables may be any text
    moved = regrid_streams(
        [(fields[v].withColumnRenamed("value", f"_v{i}"), weights[v], [f"_v{i}"]) for i, v in enumerate(names)]
        + [(geopotential.withColumnRenamed("value", "geopotential"), geopotential_weights, ["geopotential"])]
    )
    profiles = _profiles(moved, names)
    own = (filter_bbox(target, box) if box is not None else target).withColumn(
        "dst_id", F.expr(cell_id("lat", "lon"))
    )
    carried = [c for c in ("lev",) if c in own.columns]
    points = own.selectExpr("var", "dst_id", *POINT, *carried, "value AS own")
    points = _with_heights(points, heights)
    lines = vertical_interpolation(
        profiles, points, x="zfull", columns=("var", "time", "dst_id"), missing=missing
    )
    return lines.selectExpr(
        "var", "time", "dst_id", "lev_idx", *carried, "lat", "lon", "coalesce(value, own) AS value"
    )


def _profiles(moved: DataFrame, names: Sequence[str]) -> DataFrame:
    """Regridded columns _v0, _v1 and so on as rows of their variable, each with the height z."""
    each = F.explode(
        F.array(*[F.struct(F.lit(v).alias("var"), F.col(f"_v{i}").alias("value")) for i, v in enumerate(names)])
    )
    return moved.select(
        "time", "lev_idx", "dst_id", geopotential_height(F.col("geopotential")).alias("z"), each.alias("_e")
    ).select("time", "lev_idx", "dst_id", "z", "_e.var", "_e.value")


def interpolate_variables_to_levels(
    sources: Mapping[str, DataFrame], geopotential: DataFrame, weights: DataFrame, heights: DataFrame,
    every: str = "6 hours",
) -> DataFrame:
    """The first version for several variables of one source grid, in one plan.

    ``sources`` has a field (time, lev_idx, lat, lon, value) per variable, on the cells of
    ``geopotential``. Returns var, time, dst_id, lev_idx, value, see ``interpolate_to_levels``: a row
    per variable for every step that any of the fields has.

    The fields are stacked, so one aggregation makes the means of all of them and another one regrids
    them: the geopotential is read, averaged and moved once. A bin may cross the ends of files. The
    steps come from the time column alone, not from the means.
    """
    names = list(sources)
    columns = [f"_v{i}" for i in range(len(names))]  # names of variables may be any text
    stacked = stack_variables(
        {**dict(zip(columns, (clip_latitude(sources[v]) for v in names), strict=True)),
         "geopotential": clip_latitude(geopotential)},
        POINT,
    )
    means = resample_mean(stacked, every, POINT[1:], [*columns, "geopotential"])
    profiles = _profiles(regrid(means, weights, [*columns, "geopotential"]), names)
    steps = stacked.selectExpr(f"window(time, '{every}').start AS time").where("time IS NOT NULL").distinct()
    steps = steps.select("time", F.explode(F.array(*[F.lit(v) for v in names])).alias("var"))
    wanted = at_every_step(steps, heights.select("dst_id", "lev_idx", "zfull"))
    return vertical_interpolation(
        profiles, wanted, x="zfull", above="extrapolate", columns=("var", "time", "dst_id")
    ).drop("zfull")


def _require_same_times(fields: Mapping[str, DataFrame], geopotential: DataFrame, target: DataFrame) -> None:
    """Raise when a variable or the geopotential does not have the times of its target: one job."""
    times = target.select("var", "time").distinct()
    inputs = [df.select(F.lit(v).alias("var"), "time") for v, df in fields.items()]
    # the geopotential stands beside every variable
    every = F.explode(F.array(*[F.lit(f"geopotential of {v}") for v in fields])).alias("var")
    inputs.append(geopotential.select("time").distinct().select(every, "time"))
    wanted = times.union(times.select(F.concat(F.lit("geopotential of "), "var"), "time"))
    have = reduce(DataFrame.union, inputs).distinct()
    wrong = unmatched(have, wanted, ["var", "time"]).select("var").distinct().limit(1).collect()
    if wrong:
        raise ValueError(f"{wrong[0]['var']} and target do not have the same times")


def _require_common_cells(inputs: Mapping[str, tuple[DataFrame, DataFrame]]) -> None:
    """Raise when no cell of one of the fields is in its weights: one job for all of them."""
    met = [
        df.selectExpr(f"{cell_id('lat', 'lon')} AS src_id")
        .join(weights.select("src_id"), "src_id", "left_semi")
        .limit(1)
        .select(F.lit(name).alias("name"))
        for name, (df, weights) in inputs.items()
    ]
    found = {r["name"] for r in reduce(DataFrame.union, met).collect()}
    for name in inputs:
        if name not in found:
            raise ValueError(f"no cell of the {name} meets its weights")


def _with_heights(points: DataFrame, heights: DataFrame) -> DataFrame:
    """Heights of a column's levels reach the target rows as one short map per cell (and time): the
    join is on the column alone, by far fewer rows than the field has."""
    keys = [c for c in ("time", "dst_id") if c in heights.columns]
    maps = heights.where("zfull IS NOT NULL").groupBy(*keys).agg(
        F.expr("map_from_entries(collect_list(struct(lev_idx, zfull))) AS _z")
    )
    return points.join(maps, keys, "left").withColumn(
        "zfull", F.expr("element_at(_z, lev_idx)")
    ).drop("_z")


def _require_common_cell(field: DataFrame, weights: DataFrame, name: str) -> None:
    """Raise when no cell of the field is in the weights: another grid, or a wrong one."""
    cells = field.selectExpr(f"{cell_id('lat', 'lon')} AS src_id")
    if cells.join(weights.select("src_id"), "src_id", "left_semi").isEmpty():
        raise ValueError(f"no cell of the {name} meets its weights")


@dataclass(frozen=True)
class Job:
    """Parameters of a run over stored fields."""

    input_path: str
    geopotential_path: str
    target_path: str
    output_path: str
    weights_path: str
    target_vars: tuple[str, ...] = ("hus", "ta", "ua", "va")
    input_model: str = "reanalysis"
    target_name: str = "gcm"
    geopotential_var: str = "z"
    years: tuple[int, int] = (1982, 2012)
    box: Box | None = field(default=None)
    periodic: bool = False
    strict: bool = True
    missing: str = "break"
    #: stored heights of the target's levels; without them sigma-pressure levels are computed
    heights_path: str | None = None
    #: the target's humidity, for moist heights of sigma-pressure levels
    humidity_var: str | None = None


def _weights_key(method: str, job: Job) -> str:
    return f"{method}_periodic" if job.periodic else method


def run_surface(
    spark: SparkSession, job: Job, target_var: str = "tos"
) -> DataFrame:
    """Regrid and store a surface variable; returns the months of the period without input."""
    input_var = map_variable(target_var, job.input_model)
    source = scan_field(spark, job.input_path, input_var, job.years)
    method = regrid_method(input_var)
    src_grid = catalogue(spark, job.input_path, input_var, job.weights_path, job.years).cells.persist()
    dst_grid = catalogue(spark, job.target_path, target_var, job.weights_path).cells.persist()
    weights = load_or_make_weights(
        spark, job.weights_path, _weights_key(method, job), src_grid, [dst_grid],
        lambda: build_weights(method, src_grid, dst_grid, dst_grid, job.periodic),
    )
    out = regrid_surface(source, dst_grid, method, weights)
    write_field(build_output(out, target_var, "value"), job.output_path)
    src_grid.unpersist()
    dst_grid.unpersist()
    return discover_months(spark, job.input_path, input_var, *job.years)


@dataclass(frozen=True)
class Group:
    """Target variables of one grid, and the plan that makes them all."""

    variables: tuple[str, ...]
    result: DataFrame
    attrs: Mapping[str, Mapping[str, str]]
    kept: Sequence[DataFrame]


def plan_interpolation(
    spark: SparkSession, job: Job, heights: DataFrame | None = None, stagger: Sequence[str] = WIND
) -> Iterator[Group]:
    """The plans of ``run_interpolation``, one for all variables that share a target grid.

    Each is made when it is asked for, as the strict checks run then.
    """
    def known(path: str, var: str) -> Catalogue:
        return catalogue(spark, path, var, job.weights_path, job.years)

    targets: dict[tuple[str, bool], list[str]] = {}
    entries: dict[str, Catalogue] = {}
    grids: dict[str, DataFrame] = {}
    for target_var in job.target_vars:
        input_var = map_variable(target_var, job.input_model)
        wanted = filter_years(available_months(spark, job.target_path, target_var), *job.years)
        require_nonempty(wanted, f"variable {target_var}")
        for path, var in (
            (job.input_path, input_var), (job.geopotential_path, job.geopotential_var),
        ):
            lacking = wanted.join(available_months(spark, path, var), ["year", "month"], "left_anti")
            if not lacking.isEmpty():
                raise ValueError(f"target months without input of variable {var}")
        entries[target_var] = known(job.target_path, target_var)
        grids[target_var] = entries[target_var].cells.persist()
        targets.setdefault((grid_fingerprint(grids[target_var]), target_var in stagger), []).append(target_var)

    geopotential = scan_field(
        spark, job.geopotential_path, job.geopotential_var, job.years, hours=SYNOPTIC_HOURS
    )
    z_entry = known(job.geopotential_path, job.geopotential_var)
    z_grid = z_entry.cells.persist()
    for (_, staggered), names in targets.items():
        whole_grid = grids[names[0]]
        grid = filter_bbox(whole_grid, job.box) if job.box else whole_grid
        kept = [z_grid] + [grids[v] for v in names]

        def stored(method: str, cells: DataFrame, grid=grid, whole_grid=whole_grid) -> DataFrame:
            return load_or_make_weights(
                spark, job.weights_path, _weights_key(method, job), cells, [grid, whole_grid],
                lambda: build_weights(method, cells, whole_grid, grid, job.periodic),
            )

        sources, attrs, times, cells = {}, {}, {}, {}
        for v in names:
            input_var = map_variable(v, job.input_model)
            values = scan_field(spark, job.input_path, input_var, job.years, hours=SYNOPTIC_HOURS)
            entry = known(job.input_path, input_var)
            kept.append(entry.cells.persist())
            sources[v] = (values, stored(regrid_method(input_var), kept[-1]))
            times[v], cells[v] = filter_synoptic(entry.times), (kept[-1], sources[v][1])
            attrs[v] = {
                **read_attrs(spark, f"{job.input_path}_attrs", input_var), "interpolation_to": job.target_name,
            }
        levels = heights
        if levels is None:
            # staggered variables need heights around their box as well
            levels = stored_heights(
                spark, job.target_path, names[0], job.years, None if staggered else job.box,
                job.heights_path, job.humidity_var,
            )
        if staggered:
            # heights go with the method of the variables, which winds share
            kept.append(scan_grid(levels).persist())
            method = regrid_method(map_variable(names[0], job.input_model))
            on_grid = regrid_heights(levels, stored(method, kept[-1]))
        else:
            on_grid = with_cells(levels)
        z_weights = stored("bilinear", z_grid)
        if job.strict:
            # by the catalogue: no row of a field is read
            wanted = [entries[v].times.withColumn("var", F.lit(v)) for v in names]
            _require_same_times(times, filter_synoptic(z_entry.times), reduce(DataFrame.unionByName, wanted))
            _require_common_cells({**cells, "geopotential": (z_grid, z_weights)})
        target = reduce(
            DataFrame.unionByName, [scan_field(spark, job.target_path, v, job.years) for v in names]
        )
        filled = interpolate_variables(
            sources, geopotential, z_weights, target, on_grid, job.box, strict=False, missing=job.missing
        )
        out = filled.selectExpr(
            "time", *[c for c in ("lev_idx", "lev") if c in filled.columns], "lat", "lon", "value", "var",
            "year(time) AS year", "month(time) AS month",
        )
        yield Group(tuple(names), out, attrs, kept)


def run_interpolation(
    spark: SparkSession, job: Job, heights: DataFrame | None = None, stagger: Sequence[str] = WIND
) -> None:
    """Interpolate and store every variable of the job, all years and months in one plan for all
    variables that share a target grid.

    ``heights`` has lat, lon, lev_idx, zfull and maybe time, on the grid of the mass variables;
    without it the job takes what the target's levels are from beside the stored target, and reads
    or computes their heights, see ``stored_heights``. For the staggered variables heights are
    regridded first. A month of the target without input is an error. Cells and times of inputs and
    targets come from their catalogue beside the weights, which reads the coordinate columns of months
    it does not know yet. The geopotential is read and regridded once per target grid.
    """
    for group in plan_interpolation(spark, job, heights, stagger):
        # a column of one variable carries all of its attributes, the table those of each
        shared = dict(set.intersection(*[set(a.items()) for a in group.attrs.values()]))
        write_field(attach_attrs(group.result, "value", shared), job.output_path)
        for var, attrs in group.attrs.items():
            write_attrs(attrs_table(spark, var, attrs), f"{job.output_path}_attrs")
        for df in group.kept:
            df.unpersist()


def run_levels(spark: SparkSession, job: Job, heights: DataFrame, every: str = "6 hours") -> None:
    """The first version over stored fields: 6-hourly means of all variables of the job at the heights of
    the target's levels, stored by variable, year and month.

    ``heights`` has lat, lon, lev_idx, zfull. All fields are moved bilinearly from one grid: a variable on
    other cells than the geopotential's is an error, as is a month that one of the two lacks. Target
    fields are not read.
    """
    z = scan_field(spark, job.geopotential_path, job.geopotential_var, job.years)
    z_months = filter_years(available_months(spark, job.geopotential_path, job.geopotential_var), *job.years)
    grid = catalogue(
        spark, job.geopotential_path, job.geopotential_var, job.weights_path, job.years
    ).cells.persist()
    fingerprint = grid_fingerprint(grid)
    sources, attrs = {}, {}
    for v in job.target_vars:
        var = map_variable(v, job.input_model)
        months = filter_years(available_months(spark, job.input_path, var), *job.years)
        require_nonempty(months, f"variable {var}")
        if not unmatched(months, z_months, ["year", "month"]).isEmpty():
            raise ValueError(f"variable {var} and the geopotential do not have the same months")
        sources[v] = scan_field(spark, job.input_path, var, job.years)
        own = catalogue(spark, job.input_path, var, job.weights_path, job.years)
        if grid_fingerprint(own.cells) != fingerprint:
            raise ValueError(f"variable {var} and the geopotential do not have the same cells")
        attrs[v] = {**read_attrs(spark, f"{job.input_path}_attrs", var), "interpolation_to": job.target_name}
    cells = scan_grid(heights).persist()
    weights = load_or_make_weights(
        spark, job.weights_path, _weights_key("bilinear", job), grid, [cells],
        lambda: build_weights("bilinear", grid, cells, cells, job.periodic),
    )
    out = with_coordinates(interpolate_variables_to_levels(sources, z, weights, with_cells(heights), every))
    write_field(
        out.selectExpr(
            "time", "lev_idx", "CAST(NULL AS DOUBLE) AS lev", "lat", "lon", "value", "var",
            "year(time) AS year", "month(time) AS month",
        ),
        job.output_path,
    )
    for v in job.target_vars:
        write_attrs(attrs_table(spark, v, attrs[v]), f"{job.output_path}_attrs")
    grid.unpersist()
    cells.unpersist()
