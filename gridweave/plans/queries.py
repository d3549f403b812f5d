"""One query per operator over the relational test tables.

Each takes (spark, sf_dir) and returns a lazy DataFrame over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.functions import coords, physics
from gridweave.operators import (
    align,
    coordinates,
    correct,
    grids,
    profiles,
    resample,
    selection,
    stats,
    vertical,
    weights,
)
from gridweave.operators.regrid import merge_weights, regrid
from gridweave.plans import heights, jobs
from gridweave.sources import fields, store
from gridweave.sources import tables as t
from gridweave.sources.catalogue import catalogue

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BOX = selection.Box(-45.0, 45.0, 60.0, 270.0)
CELL = ("time", "lat", "lon")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def shown(df: DataFrame, **digits: int) -> DataFrame:
    """Rounded doubles and times as text, for comparison between engines."""
    columns = []
    for name, kind in df.dtypes:
        if kind == "double":
            columns.append(f"round({name}, {digits.get(name, 6)}) AS {name}")
        elif kind.startswith("timestamp"):
            columns.append(f"left(CAST({name} AS STRING), 19) AS {name}")
        else:
            columns.append(name)
    return df.selectExpr(*columns)


def on_map(df: DataFrame) -> DataFrame:
    """Cell id replaced by its coordinates, where the rows do not have their own."""
    return (df if "lat" in df.columns else coordinates.with_coordinates(df)).drop("dst_id")


def weights_between_cells(spark: SparkSession, sf: str, method: str) -> DataFrame:
    return weights.build_weights(method, t.source_cells(spark, sf), t.target_cells(spark, sf))


def shown_weights(w: DataFrame) -> DataFrame:
    named = w.selectExpr(
        "dst_id", "w", "n_src",
        f"{coords.cell_lat('src_id')} AS src_lat", f"{coords.cell_lon('src_id')} AS src_lon",
    )
    return shown(on_map(named), w=9)


# Selection, names, coordinates -------------------------------------------------------------


@query
def clip_latitude(spark, sf):
    orders = t.table(spark, sf, "orders")
    raw = orders.select("o_orderkey", (F.lit(-93.0) + 31 * (F.col("o_custkey") % 7)).alias("lat"))
    return shown(coordinates.clip_latitude(raw))


@query
def filter_bbox(spark, sf):
    return shown(selection.filter_bbox(t.target_field(spark, sf), BOX))


@query
def filter_month(spark, sf):
    return shown(selection.filter_month(t.target_field(spark, sf), 1997, 5))


@query
def filter_years(spark, sf):
    return shown(selection.filter_years(t.target_field(spark, sf), 1996, 1998))


@query
def filter_synoptic(spark, sf):
    return shown(selection.filter_synoptic(t.events_series(spark, sf)))


@query
def level_slice(spark, sf):
    field = t.target_field(spark, sf)
    return shown(selection.level_slice(field, 1, -1, CELL))


@query
def first_slice(spark, sf):
    return shown(selection.first_slice(t.target_field(spark, sf)))


@query
def rename_vars(spark, sf):
    named = t.target_field(spark, sf).withColumnRenamed("value", "q")
    return shown(coordinates.rename_vars(named, {"q": "hus", "sst": "tos"}))


@query
def map_variable(spark, sf):
    series = t.events_series(spark, sf)
    names = {"view": "q", "click": "t", "error": "u", "purchase": "v", "signup": "sst"}
    observed = coordinates.relabel_vars(series, names)
    back = {coordinates.map_variable(v, "reanalysis"): v for v in ("hus", "ta", "ua", "va", "tos")}
    renamed = coordinates.relabel_vars(observed, back)
    return shown(renamed.groupBy("var").agg(F.count("*").alias("n"), F.sum("value").alias("total")), total=3)


@query
def regrid_method(spark, sf):
    series = t.events_series(spark, sf)
    names = {"view": "q", "click": "t", "error": "u", "purchase": "v", "signup": "sst"}
    methods = {v: coordinates.regrid_method(v) for v in names.values()}
    observed = coordinates.relabel_vars(series, names)
    chosen = observed.withColumn("method", F.col("var")).replace(methods, subset=["method"])
    return chosen.groupBy("var", "method").agg(F.count("*").alias("n"))


@query
def standardize_coords(spark, sf):
    field = t.target_field(spark, sf).withColumn("longitude", F.col("lon"))
    field = field.withColumn("latitude", F.col("lat") + 1.0).withColumnRenamed("lev_idx", "lev")
    return shown(coordinates.standardize_coords(field))


@query
def standardize_dims(spark, sf):
    field = t.target_field(spark, sf).withColumnsRenamed(
        {"time": "when", "lat": "y", "lon": "grid_lon", "lev_idx": "model_level"}
    )
    # levels far above 180 are not taken for a horizontal axis
    field = field.withColumn("model_level", F.col("model_level") * 1000)
    return shown(
        coordinates.standardize_dims(field, ["when", "y", "grid_lon", "model_level"])
    )


@query
def assign_levels(spark, sf):
    labels = t.sigma_levels(spark).select("lev_idx", F.col("ap").alias("lev"))
    return shown(coordinates.assign_levels(t.target_field(spark, sf), labels))


@query
def scan_grid(spark, sf):
    return shown(grids.scan_grid(t.target_field(spark, sf)).select("lat", "lon"))


@query
def axis_bounds(spark, sf):
    axes = grids.grid_axes(t.source_cells(spark, sf))
    lat = grids.axis_bounds(axes, "lats").withColumn("axis", F.lit("lat"))
    lon = grids.axis_bounds(axes, "lons").withColumn("axis", F.lit("lon"))
    return shown(lat.unionByName(lon))


# Alignment ----------------------------------------------------------------------------------


@query
def combine_by_coords(spark, sf):
    field = t.target_field(spark, sf)
    split = F.year("time") < 1998
    whole = align.combine_by_coords(
        [field.where(split), field.where(~split)], ["time", "lev_idx", "lat", "lon"]
    )
    return shown(whole)


@query
def duplicate_coords(spark, sf):
    return shown(align.duplicate_coords(t.station_series(spark, sf), ["var", "cell"]))


@query
def align_exact(spark, sf):
    surface = t.surface_field(spark, sf).withColumnRenamed("value", "surface")
    upper = t.source_field(spark, sf).select("time", "lev_idx", "lat", "lon", "value")
    return shown(align.align_exact(upper, surface, CELL))


@query
def unmatched_coords(spark, sf):
    left = t.source_field(spark, sf)
    right = t.target_field(spark, sf)
    return shown(align.unmatched(left, right, ["time", "lev_idx"]))


@query
def missing_months(spark, sf):
    orders = t.table(spark, sf, "orders")
    months = orders.select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    return align.missing_months(months, 1995, 2001)


@query
def output_key(spark, sf):
    field = t.target_field(spark, sf)
    key = store.output_key("ta", "reanalysis", "gcm", F.year("time"), F.month("time"))
    return field.groupBy(key.alias("name")).agg(F.count("*").alias("n"))


@query
def fill_above_top(spark, sf):
    keys = ["time", "lev_idx", "lat", "lon"]
    source = t.target_field(spark, sf)
    holes = source.withColumn("value", F.when(F.col("value") < 8.0, F.col("value")))
    spare = source.withColumn("value", F.col("value") * 100.0)
    return shown(align.fill_from(holes, spare, keys))


# Encoded input ------------------------------------------------------------------------------


@query
def decode_time(spark, sf):
    li = t.table(spark, sf, "lineitem").select(
        "l_orderkey", (F.col("l_orderkey") * 7 + F.col("l_linenumber")).alias("time"),
        F.col("l_quantity").alias("value"),
    )
    decoded = fields.decode_cf(
        li, "hours since 1949-12-31 18:30", values=["value"], scale=0.25, offset=-3.0, fill=7.0
    )
    return shown(decoded)


@query
def decode_noleap(spark, sf):
    orders = t.table(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_orderkey") * 0.25 + 0.5).alias("time")
    )
    decoded = fields.decode_cf(orders, "days since 1850-03-01", "noleap", parts=True)
    return shown(decoded)


# Time -----------------------------------------------------------------------------------------


@query
def resample_6h_mean(spark, sf):
    return shown(resample.resample_mean(t.events_series(spark, sf), by=("var", "cell")))


@query
def resample_6h_mean_filled(spark, sf):
    series = t.events_series(spark, sf)
    return shown(resample.resample_mean(series, by=("var", "cell"), fill_gaps=True))


# Weights and regridding -----------------------------------------------------------------------


@query
def weights_bilinear(spark, sf):
    return shown_weights(weights_between_cells(spark, sf, "bilinear"))


@query
def weights_bilinear_periodic(spark, sf):
    w = weights.build_weights(
        "bilinear", t.source_cells(spark, sf), t.target_cells(spark, sf), periodic=True
    )
    return shown_weights(w)


@query
def weights_conservative(spark, sf):
    return shown_weights(weights_between_cells(spark, sf, "conservative"))


@query
def weights_nearest_s2d(spark, sf):
    return shown_weights(weights_between_cells(spark, sf, "nearest_s2d"))


@query
def weights_nearest_d2s(spark, sf):
    return shown_weights(weights_between_cells(spark, sf, "nearest_d2s"))


@query
def weights_patch(spark, sf):
    return shown_weights(weights_between_cells(spark, sf, "patch"))


def _regridded(spark, sf, method, values=("value",)):
    w = weights_between_cells(spark, sf, method)
    return regrid(t.source_field(spark, sf), w, values)


@query
def regrid_bilinear(spark, sf):
    return shown(on_map(_regridded(spark, sf, "bilinear")))


@query
def regrid_conservative(spark, sf):
    return shown(on_map(_regridded(spark, sf, "conservative")))


@query
def regrid_nearest(spark, sf):
    return shown(on_map(_regridded(spark, sf, "nearest_s2d")))


@query
def regrid_nearest_reverse(spark, sf):
    return shown(on_map(_regridded(spark, sf, "nearest_d2s")))


@query
def regrid_patch(spark, sf):
    return shown(on_map(_regridded(spark, sf, "patch")))


@query
def regrid_mixed_methods(spark, sf):
    w = merge_weights(
        {m: weights_between_cells(spark, sf, m) for m in ("bilinear", "conservative")}
    )
    out = regrid(
        t.source_field(spark, sf), w, {"humidity": "conservative", "value": "bilinear"}
    )
    return shown(on_map(out))


@query
def regrid_null_guard(spark, sf):
    field = t.source_field(spark, sf)
    # NaN and NULL values count as missing like absent rows
    holes = field.withColumn(
        "value",
        F.when(F.col("value") < 14.0, F.col("value")).when(F.col("value") > 17.0, F.lit(float("nan"))),
    )
    out = regrid(holes, weights_between_cells(spark, sf, "bilinear"))
    return shown(on_map(out))


@query
def regrid_wind_heights(spark, sf):
    zfull = t.static_heights(spark, sf)
    w = weights.build_weights("bilinear", t.target_cells(spark, sf), t.wind_grid(spark, sf))
    return shown(on_map(heights.regrid_heights(zfull, w)), zfull=3)


@query
def surface_job(spark, sf):
    source = t.surface_field(spark, sf)
    cells = t.target_cells(spark, sf)
    w = weights_between_cells(spark, sf, "bilinear")
    return shown(jobs.regrid_surface(source, cells, weights=w).drop("dst_id"))


# Heights ------------------------------------------------------------------------------------


@query
def geopotential_height(spark, sf):
    field = t.source_field(spark, sf)
    z = physics.geopotential_height(F.col("geopotential"))
    return shown(field.select("time", "lev_idx", "lat", "lon", z.alias("z")), z=3)


@query
def hybrid_height(spark, sf):
    orog = t.target_surface_pressure(spark, sf).withColumn("orog", F.col("ps") - 94900.0).drop("ps")
    return shown(vertical.hybrid_heights(orog, t.hybrid_levels(spark)), zfull=3, orog=3)


@query
def pressure_levels(spark, sf):
    ps = t.target_surface_pressure(spark, sf)
    return shown(vertical.pressure_levels(ps, t.sigma_levels(spark)), p=3, ps=3)


def _model_columns(spark, sf):
    """Temperature and pressure on the source's levels, pressure falling with the level."""
    field = t.source_field(spark, sf)
    return field.select(
        "time", "lev_idx", "lat", "lon",
        (F.lit(100000.0) - 13000.0 * F.col("lev_idx") + F.col("value")).alias("p"),
        (F.lit(200.0) + F.col("value")).alias("ta"),
        F.col("humidity").alias("hus"),
    )


@query
def hypsometric_height(spark, sf):
    out = vertical.hypsometric_heights(_model_columns(spark, sf), "p", "ta", columns=CELL)
    return shown(out.select("time", "lev_idx", "lat", "lon", "zfull"), zfull=3)


@query
def hypsometric_height_moist(spark, sf):
    out = vertical.hypsometric_heights(
        _model_columns(spark, sf), "p", "ta", "hus", CELL, "pressure_desc"
    )
    return shown(out.select("time", "lev_idx", "lat", "lon", "zfull"), zfull=3)


@query
def adjust_edges(spark, sf):
    field = t.source_field(spark, sf)
    z = field.withColumn("z", physics.geopotential_height(F.col("geopotential")))
    return shown(vertical.adjust_edges(z, "z", CELL), z=3)


@query
def target_heights_static(spark, sf):
    static = t.static_heights(spark, sf)
    return shown(heights.target_heights("hybrid height coordinate", static=static), zfull=3)


def _sigma_heights(spark, sf):
    model = heights.with_cells(
        t.target_field(spark, sf).withColumn("ta", F.lit(230.0) + F.col("value")).drop("value")
    )
    ps = heights.with_cells(t.target_surface_pressure(spark, sf))
    return heights.target_heights(
        "atmosphere_hybrid_sigma_pressure_coordinate",
        model=model.join(ps, ["time", "dst_id"]), coefficients=t.sigma_levels(spark),
    )


@query
def target_heights_sigma(spark, sf):
    return shown(on_map(_sigma_heights(spark, sf)), zfull=3)


# Vertical -------------------------------------------------------------------------------------


@query
def vertical_interp(spark, sf):
    out = vertical.vertical_interpolation(
        t.embedding_profiles(spark, sf), t.embedding_targets(spark, sf), columns=("vec_id",)
    )
    return shown(out)


@query
def vertical_interp_extrapolate(spark, sf):
    out = vertical.vertical_interpolation(
        t.embedding_profiles(spark, sf), t.embedding_targets(spark, sf), columns=("vec_id",),
        above="extrapolate",
    )
    return shown(out)


def _with_holes(spark, sf):
    """Values missing at the bottom of some columns and inside all."""
    known = "lev_idx % 9 <> 4 AND NOT (lev_idx = 0 AND vec_id % 3 = 0)"
    return t.embedding_profiles(spark, sf).withColumn("value", F.expr(f"CASE WHEN {known} THEN value END"))


@query
def vertical_interp_missing(spark, sf):
    out = vertical.vertical_interpolation(
        _with_holes(spark, sf), t.embedding_targets(spark, sf), columns=("vec_id",)
    )
    return shown(out)


@query
def vertical_interp_bridged(spark, sf):
    out = vertical.vertical_interpolation(
        _with_holes(spark, sf), t.embedding_targets(spark, sf), columns=("vec_id",), missing="bridge"
    )
    return shown(out)


@query
def vertical_interp_static(spark, sf):
    moved = _regridded(spark, sf, "bilinear", ("value", "geopotential"))
    columns = moved.withColumn("z", physics.geopotential_height(F.col("geopotential")))
    targets = heights.with_cells(t.static_heights(spark, sf))
    out = vertical.vertical_interpolation(columns, targets, x="zfull")
    return shown(on_map(out).drop("zfull"))


@query
def to_profiles(spark, sf):
    vectors = t.table(spark, sf, "embeddings")
    rows = profiles.from_arrays(vectors, ["vec_id", "label"], "embedding")
    arrays = profiles.to_profiles(rows, ["vec_id", "label"])
    return shown(profiles.from_profiles(arrays, ["vec_id", "label"]))


def column_mean(pdf):
    """Thickness-weighted mean of one column."""
    import pandas as pd

    pdf = pdf.sort_values("lev_idx")
    z, v = pdf["z"].to_numpy(), pdf["value"].to_numpy()
    area = ((v[1:] + v[:-1]) / 2 * (z[1:] - z[:-1])).sum()
    return pd.DataFrame({"vec_id": [pdf["vec_id"].iloc[0]], "mean": [area / (z[-1] - z[0])]})


@query
def apply_profile(spark, sf):
    out = profiles.apply_profile(
        t.embedding_profiles(spark, sf), column_mean, "vec_id long, mean double", ["vec_id"]
    )
    return shown(out)


# Jobs -------------------------------------------------------------------------------------------


@query
def interp3d_v1(spark, sf):
    out = jobs.interpolate_to_levels(
        t.source_field(spark, sf), t.target_cells(spark, sf),
        heights.with_cells(t.static_heights(spark, sf)),
        weights=weights_between_cells(spark, sf, "bilinear"),
    )
    return shown(on_map(out))


@query
def interp3d_v2(spark, sf):
    w = weights.build_weights(
        "bilinear", t.source_cells(spark, sf), t.target_cells(spark, sf),
        grids.scan_grid(selection.filter_bbox(t.target_cells(spark, sf), BOX)),
    )
    out = jobs.interpolate_and_fill(
        t.source_field(spark, sf), t.target_field(spark, sf),
        heights.with_cells(t.static_heights(spark, sf)), box=BOX, years=(1996, 2000),
        weights={"bilinear": w},
    )
    return shown(on_map(out))


@query
def interp3d_v2_staggered(spark, sf):
    """Variable and geopotential on different grids, each with weights of its own."""
    out = jobs.interpolate_and_fill(
        t.source_field(spark, sf).drop("geopotential"), t.target_field(spark, sf),
        heights.with_cells(t.static_heights(spark, sf)), box=BOX, years=(1996, 2000), strict=False,
        geopotential=t.staggered_geopotential(spark, sf),
    )
    return shown(on_map(out))


@query
def interp3d_v2_humidity(spark, sf):
    source = t.source_field(spark, sf)
    w = {m: weights_between_cells(spark, sf, m) for m in ("bilinear", "conservative")}
    out = jobs.interpolate_and_fill(
        source.withColumn("value", F.col("humidity") * 1000), t.target_field(spark, sf),
        heights.with_cells(t.static_heights(spark, sf)), "conservative", weights=w, strict=False,
    )
    return shown(on_map(out))


@query
def interp3d_v2_sigma(spark, sf):
    model = t.target_field(spark, sf).join(t.target_surface_pressure(spark, sf), list(CELL))
    model = model.withColumn("ta", F.lit(230.0) + F.col("value"))
    target = heights.sigma_heights(model, t.sigma_levels(spark), columns=CELL)
    out = jobs.interpolate_and_fill(
        t.source_field(spark, sf), target, None, strict=False,
        weights={"bilinear": weights_between_cells(spark, sf, "bilinear")},
    )
    return shown(on_map(out))


@query
def interp3d_v2_stored_heights(spark, sf):
    folder = store.shared_folder(spark, "heights")
    made = coordinates.with_coordinates(_sigma_heights(spark, sf))
    store.write_field(coordinates.build_output(made, "zfull", "zfull"), folder)
    stored = fields.scan_heights(spark, folder, "zfull")
    out = jobs.interpolate_and_fill(
        t.source_field(spark, sf), t.target_field(spark, sf), heights.with_cells(stored),
        strict=False, weights={"bilinear": weights_between_cells(spark, sf, "bilinear")},
    )
    return shown(on_map(out))


# Stored fields ----------------------------------------------------------------------------------


def _stored(spark, sf, folder):
    """Source and target written as stored fields."""
    source = t.source_field(spark, sf)
    for var, value in (("t", "value"), ("z", "geopotential")):
        store.write_field(coordinates.build_output(source, var, value), f"{folder}/source")
    target = t.target_field(spark, sf).withColumn("lev", F.col("lev_idx") * 10.0)
    store.write_field(coordinates.build_output(target, "ta", "value"), f"{folder}/target")


@query
def store_and_scan(spark, sf):
    folder = store.shared_folder(spark, "scan")
    store.write_field(
        coordinates.build_output(t.target_field(spark, sf), "ta", "value"), folder
    )
    scanned = fields.scan_field(spark, folder, "ta", (1996, 1997), (1, 2, 6))
    return shown(scanned.drop("lev"))


def _catalogued(spark, sf):
    """Catalogue of a field of which one month was written again after it was known."""
    folder = store.shared_folder(spark, "catalogue")
    target = t.target_field(spark, sf)
    again = target.where("year(time) = 1996 AND month(time) = 1")
    less = coordinates.build_output(target.where("NOT (year(time) = 1996 AND month(time) = 1)"), "ta", "value")
    # at first one month has other cells and times
    wrong = coordinates.build_output(again.selectExpr(
        "time + INTERVAL 1 HOUR AS time", "lev_idx", "lat + 0.25D AS lat", "lon", "value"
    ), "ta", "value")
    store.write_field(less, f"{folder}/field")
    store.write_field(wrong, f"{folder}/field")
    catalogue(spark, f"{folder}/field", "ta", folder)
    store.write_field(coordinates.build_output(again, "ta", "value"), f"{folder}/field")
    return catalogue(spark, f"{folder}/field", "ta", folder)


@query
def catalogue_cells(spark, sf):
    return shown(_catalogued(spark, sf).cells.select("lat", "lon"))


@query
def catalogue_times(spark, sf):
    return shown(_catalogued(spark, sf).times)


@query
def stored_order(spark, sf):
    """Order of the stored rows, by their positions in the files."""
    folder = store.shared_folder(spark, "order")
    # rows come in another order than they are stored in
    mixed = t.target_field(spark, sf).repartition("lon")
    store.write_field(coordinates.build_output(mixed, "ta", "value"), folder)
    return store.stored_order(spark, folder)


@query
def scan_synoptic(spark, sf):
    """Synoptic hours of an hourly stored series, left out in the scan."""
    folder = store.shared_folder(spark, "hours")
    series = t.events_series(spark, sf).selectExpr(
        "time", "0 AS lev_idx", "0D AS lev", "0D AS lat", "CAST(cell AS DOUBLE) AS lon", "value"
    )
    store.write_field(coordinates.build_output(series, "ta", "value"), folder)
    return shown(
        fields.scan_field(spark, folder, "ta", hours=selection.SYNOPTIC_HOURS).select("time", "lon", "value")
    )


@query
def discover_months(spark, sf):
    folder = store.shared_folder(spark, "months")
    store.write_field(
        coordinates.build_output(t.target_field(spark, sf), "ta", "value"), folder
    )
    return fields.discover_months(spark, folder, "ta", 1995, 2001)


@query
def stored_weights(spark, sf):
    folder = store.shared_folder(spark, "weights")
    source, target = t.source_cells(spark, sf), t.target_cells(spark, sf)

    def load():
        return store.load_or_make_weights(
            spark, folder, "bilinear", grids.scan_grid(source), [grids.scan_grid(target)],
            lambda: weights.build_weights("bilinear", source, target),
        )

    load()
    return shown_weights(load())


@query
def stored_job(spark, sf):
    folder = store.shared_folder(spark, "job")
    _stored(spark, sf, folder)
    job = jobs.Job(
        f"{folder}/source", f"{folder}/source", f"{folder}/target", f"{folder}/out",
        f"{folder}/weights", ("ta",), years=(1996, 2000), box=BOX,
    )
    jobs.run_interpolation(spark, job, t.static_heights(spark, sf))
    out = fields.scan_field(spark, job.output_path, "ta")
    return shown(out.select("time", "lev_idx", "lev", "lat", "lon", "value"))


def _wind_source(spark, sf):
    """The source with a wind component on cells half a step off, and geopotential on others."""
    return t.source_field(spark, sf).withColumn("lon", F.col("lon") + 15.0)


def _run(spark, sf, target_var, source_var, value, folder, stagger=()):
    source = t.source_field(spark, sf) if target_var not in stagger else _wind_source(spark, sf)
    store.write_field(coordinates.build_output(source, source_var, value), f"{folder}/source")
    z = t.staggered_geopotential(spark, sf)
    store.write_field(coordinates.build_output(z, "z", "geopotential"), f"{folder}/z")
    store.write_attrs(store.attrs_table(spark, source_var, {"units": "1"}), f"{folder}/source_attrs")
    target = t.target_field(spark, sf).withColumn("lev", F.col("lev_idx") * 10.0)
    store.write_field(coordinates.build_output(target, target_var, "value"), f"{folder}/target")
    job = jobs.Job(
        f"{folder}/source", f"{folder}/z", f"{folder}/target", f"{folder}/out",
        f"{folder}/weights", (target_var,), years=(1996, 2000), box=BOX, strict=False,
    )
    jobs.run_interpolation(spark, job, t.static_heights(spark, sf), stagger)
    return job


@query
def stored_job_wind(spark, sf):
    """A wind component on a grid of its own; heights are moved to its target cells."""
    job = _run(spark, sf, "ua", "u", "value", store.shared_folder(spark, "wind"), ("ua",))
    out = fields.scan_field(spark, job.output_path, "ua")
    return shown(out.select("time", "lev_idx", "lev", "lat", "lon", "value"))


@query
def stored_job_humidity(spark, sf):
    """Humidity moves conservatively, its geopotential bilinearly, each from its own grid."""
    job = _run(spark, sf, "hus", "q", "humidity", store.shared_folder(spark, "humidity"))
    out = fields.scan_field(spark, job.output_path, "hus")
    return shown(out.select("time", "lev_idx", "lev", "lat", "lon", "value"), value=8)


@query
def stored_job_all(spark, sf):
    """Two variables of one run, each with its own method, beside one geopotential."""
    folder = store.shared_folder(spark, "all")
    source = t.source_field(spark, sf)
    target = t.target_field(spark, sf).withColumn("lev", F.col("lev_idx") * 10.0)
    for target_var, var, value in (("ta", "t", "value"), ("hus", "q", "humidity")):
        store.write_field(coordinates.build_output(source, var, value), f"{folder}/source")
        store.write_field(coordinates.build_output(target, target_var, "value"), f"{folder}/target")
    z = t.staggered_geopotential(spark, sf)
    store.write_field(coordinates.build_output(z, "z", "geopotential"), f"{folder}/z")
    job = jobs.Job(
        f"{folder}/source", f"{folder}/z", f"{folder}/target", f"{folder}/out",
        f"{folder}/weights", ("ta", "hus"), years=(1996, 2000), box=BOX, strict=False,
    )
    jobs.run_interpolation(spark, job, t.static_heights(spark, sf))
    out = [
        shown(
            fields.scan_field(spark, job.output_path, var).select(
                "time", "lev_idx", "lev", "lat", "lon", "value", "var"
            ),
            value=digits,
        )
        for var, digits in (("ta", 6), ("hus", 8))
    ]
    return out[0].unionByName(out[1])


@query
def stored_job_sigma(spark, sf):
    """A target on sigma-pressure levels: the job finds their kind beside the field and computes heights."""
    folder = store.shared_folder(spark, "sigma")
    source, target = t.source_field(spark, sf), t.target_field(spark, sf)
    for var, value in (("u", "value"), ("z", "geopotential")):
        store.write_field(coordinates.build_output(source, var, value), f"{folder}/source")
    store.write_field(coordinates.build_output(target, "ua", "value"), f"{folder}/target")
    warm = target.withColumn("value", F.lit(230.0) + F.col("value"))
    store.write_field(coordinates.build_output(warm, "ta", "value"), f"{folder}/target")
    pressure = t.target_surface_pressure(spark, sf)
    store.write_field(coordinates.build_output(pressure, "ps", "ps"), f"{folder}/target")
    store.write_levels(
        t.sigma_levels(spark), "ua", "atmosphere_hybrid_sigma_pressure_coordinate", f"{folder}/target_levels"
    )
    job = jobs.Job(
        f"{folder}/source", f"{folder}/source", f"{folder}/target", f"{folder}/out",
        f"{folder}/weights", ("ua",), years=(1996, 2000), strict=False,
    )
    jobs.run_interpolation(spark, job, stagger=())
    out = fields.scan_field(spark, job.output_path, "ua")
    return shown(out.select("time", "lev_idx", "lat", "lon", "value"))


@query
def stored_job_v1(spark, sf):
    """The first version over stored fields: two variables beside one geopotential."""
    folder = store.shared_folder(spark, "v1")
    source = t.source_field(spark, sf)
    for var, value in (("t", "value"), ("q", "humidity"), ("z", "geopotential")):
        store.write_field(coordinates.build_output(source, var, value), f"{folder}/source")
    job = jobs.Job(
        f"{folder}/source", f"{folder}/source", f"{folder}/target", f"{folder}/out",
        f"{folder}/weights", ("ta", "hus"), years=(1996, 2000),
    )
    jobs.run_levels(spark, job, t.static_heights(spark, sf))
    out = [
        shown(
            fields.scan_field(spark, job.output_path, var).select("time", "lev_idx", "lat", "lon", "value", "var"),
            value=digits,
        )
        for var, digits in (("ta", 6), ("hus", 8))
    ]
    return out[0].unionByName(out[1])


@query
def attrs(spark, sf):
    """Attributes stored with a field: the input's, and the target model's name."""
    job = _run(spark, sf, "hus", "q", "humidity", store.shared_folder(spark, "attrs"))
    return spark.read.parquet(f"{job.output_path}_attrs")


@query
def scan_static(spark, sf):
    folder = store.shared_folder(spark, "static")
    static = t.static_heights(spark, sf).selectExpr("lev_idx", "lat", "lon", "zfull AS value", "'zfull' AS var")
    store.write_static(static, folder)
    return shown(fields.scan_static(spark, folder, "zfull").select("lev_idx", "lat", "lon", "value"))


@query
def reformat(spark, sf):
    folder = store.shared_folder(spark, "reformat")
    field = coordinates.build_output(t.target_field(spark, sf), "t", "value")
    store.reformat(field, {"t": "ta"}, {"units": "K"}, folder)
    return shown(fields.scan_field(spark, folder, "ta").drop("lev"))


# Evaluation and correction ----------------------------------------------------------------------


def _six_hourly(spark, sf):
    return resample.resample_mean(t.station_series(spark, sf), by=("var", "cell"))


@query
def climatology(spark, sf):
    keyed = stats.with_time_keys(t.events_series(spark, sf))
    return shown(stats.climatology(keyed, ("var", "cell", "month", "hour")))


@query
def lag1_autocorr(spark, sf):
    return shown(stats.lag1_autocorrelation(_six_hourly(spark, sf), by=("var", "cell")))


@query
def cross_corr(spark, sf):
    """Every two event types."""
    return shown(stats.cross_correlations(_six_hourly(spark, sf)))


@query
def mean_abs_bias(spark, sf):
    """Every two event types."""
    return shown(stats.mean_absolute_biases(_six_hourly(spark, sf)))


@query
def subdaily_histogram(spark, sf):
    keyed = stats.with_time_keys(t.events_series(spark, sf))
    return shown(stats.histogram(keyed, 0.25, ("var", "hour")))


@query
def subdaily_quantiles(spark, sf):
    keyed = stats.with_time_keys(t.events_series(spark, sf))
    return shown(stats.quantiles(keyed, (0.1, 0.5, 0.9, 0.99), 0.25, ("var", "hour")))


@query
def drop_spin_up(spark, sf):
    return shown(stats.drop_spin_up(t.target_field(spark, sf)))


@query
def short_records(spark, sf):
    orders = t.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("cell"), F.col("o_orderdate").alias("time")
    )
    return stats.short_records(orders, minimum_years=7)


NEXT_TYPE = {
    "click": "error", "error": "purchase", "purchase": "signup", "signup": "view", "view": "click",
}


@query
def moment_correction(spark, sf):
    """Every event type against the next one by name."""
    series = stats.with_time_keys(t.station_series(spark, sf))
    model_of = F.create_map(*[F.lit(x) for pair in zip(NEXT_TYPE.values(), NEXT_TYPE, strict=True) for x in pair])
    observed = series.withColumn("var", model_of[F.col("var")])
    out = correct.moment_correction(series, series, observed, ("var", "cell", "month", "hour"))
    return shown(out.select("time", "var", "cell", "value", "corrected"))


@query
def multivariate_correction(spark, sf):
    series = _six_hourly(spark, sf)

    def wide(*names):
        a, b = names
        return series.groupBy("cell", "time").agg(
            F.max(F.when(F.col("var") == a, F.col("value"))).alias("t"),
            F.max(F.when(F.col("var") == b, F.col("value"))).alias("q"),
        )

    out = correct.multivariate_correction(
        wide("view", "click"), wide("error", "signup"), ["t", "q"], calibration=wide("purchase", "click")
    )
    return shown(out)
