"""Names, filters, alignment, stores, jobs."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from gridweave.functions import calendars
from gridweave.operators import align, coordinates, grids, resample, selection, weights
from gridweave.plans import heights, jobs
from gridweave.sources import catalogue as catalogues
from gridweave.sources import fields, store

FIELD = "time timestamp_ntz, lev_idx int, lev double, lat double, lon double, value double"


def day(d, h=0, month=1, year=2000):
    return dt.datetime(year, month, d, h)


def test_standardize_coords(spark):
    df = spark.createDataFrame([(1.0, 1.0, 5.0), (2.0, 2.0, 6.0)], "lat double, latitude double, lon double")
    assert coordinates.standardize_coords(df).columns == ["latitude", "longitude"]
    unequal = spark.createDataFrame([(1.0, 9.0)], "lat double, latitude double")
    assert coordinates.standardize_coords(unequal).columns == ["lat", "latitude"]
    empty = unequal.where("false")
    assert coordinates.standardize_coords(empty).columns == ["latitude"]


def test_standardize_dims_order_of_guesses(spark):
    df = spark.createDataFrame(
        [(day(1), 10.0, 20.0, 5000.0)], "t timestamp_ntz, x double, y double, depth double"
    )
    # x looks like a latitude and comes first; y then finds the name taken
    assert coordinates.standardize_dims(df, ["t", "x", "y", "depth"]).columns == ["time", "lat", "y", "lev"]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(90.0000001,), (-95.0,), (None,)], "lat double")
    assert [r[0] for r in coordinates.clip_latitude(df).collect()] == [90.0, -90.0, None]


def test_names_and_methods():
    assert coordinates.map_variable("hus", "reanalysis") == "q"
    assert coordinates.map_variable("hus", "gcm") == "hus"
    assert coordinates.regrid_method("q") == "conservative"
    assert coordinates.regrid_method("hus") == "bilinear"
    with pytest.raises(ValueError):
        coordinates.map_variable("hus", "other")


def test_overlap_is_an_error(spark):
    df = spark.createDataFrame([(1, 1.0)], "k int, v double")
    with pytest.raises(ValueError):
        align.combine_by_coords([df, df], ["k"])
    assert align.combine_by_coords([df, df.withColumn("k", F.lit(2))], ["k"]).count() == 2


def test_strict_alignment(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, v double")
    b = spark.createDataFrame([(1, 1.0)], "k int, w double")
    assert align.align_exact(a, b, ["k"]).count() == 1
    with pytest.raises(ValueError):
        align.align_exact(a, b, ["k"], strict=True)


def test_resample_skips_nan_and_fills_gaps(spark):
    nan = float("nan")
    rows = [(day(1, 1), 1, 2.0), (day(1, 5), 1, nan), (day(1, 13), 1, None), (day(1, 20), 2, 4.0)]
    df = spark.createDataFrame(rows, "time timestamp_ntz, cell int, value double")
    got = {(r["cell"], r["time"].hour): r["value"] for r in resample.resample_mean(df, by=["cell"]).collect()}
    assert got == {(1, 0): 2.0, (1, 12): None, (2, 18): 4.0}
    full = resample.resample_mean(df, by=["cell"], fill_gaps=True).collect()
    assert len(full) == 8 and sum(r["value"] is not None for r in full) == 2


def test_empty_and_bad_kind(spark):
    with pytest.raises(ValueError):
        align.require_nonempty(spark.range(0), "x")
    with pytest.raises(ValueError):
        heights.target_heights("sigma")
    with pytest.raises(ValueError):
        weights.build_weights("cubic", None, None)


def small_field(spark, var, fn, months=(1, 2), lats=(0.0, 10.0, 20.0), lons=(0.0, 10.0, 20.0), levels=4):
    rows = [
        (day(1, h, m), k, float(k), a, b, float(fn(k, a, b)))
        for m in months for h in (0, 6) for k in range(levels) for a in lats for b in lons
    ]
    return coordinates.build_output(spark.createDataFrame(rows, FIELD), var, "value")


def test_store_round_trip_and_month_overwrite(spark, tmp_path):
    path = str(tmp_path / "field")
    store.write_field(small_field(spark, "t", lambda k, a, b: k + a + b), path)
    store.write_field(small_field(spark, "t", lambda k, a, b: -1.0, months=(2,)), path)
    df = fields.scan_field(spark, path, "t", (2000, 2000))
    got = {r["month"]: (r["n"], r["lo"]) for r in df.groupBy("month").agg(F.count("*").alias("n"), F.min("value").alias("lo")).collect()}
    assert got == {1: (72, 0.0), 2: (72, -1.0)}
    one = fields.scan_field(spark, path, "t", (2000, 2000), [2])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    missing = fields.discover_months(spark, path, "t", 2000, 2000)
    assert sorted(r["month"] for r in missing.collect()) == list(range(3, 13))
    with pytest.raises(ValueError):
        fields.scan_field(spark, [path, path], "t")


def test_weights_store_is_keyed_by_grids(spark, tmp_path):
    base = str(tmp_path / "weights")
    src = small_field(spark, "t", lambda k, a, b: 1.0)
    calls = []

    def make(target):
        def build():
            calls.append(1)
            return weights.build_weights("bilinear", src, target)

        return build

    first = spark.createDataFrame([(5.0, 5.0)], "lat double, lon double")
    second = spark.createDataFrame([(5.0, 15.0)], "lat double, lon double")
    sg = grids.scan_grid(src)
    for target in (first, first, second):
        w = store.load_or_make_weights(
            spark, base, "bilinear", sg, [grids.scan_grid(target)], make(target)
        )
        assert w.count() == 4
    assert len(calls) == 2


def test_attrs(spark, tmp_path):
    df = store.attach_attrs(spark.range(1).withColumn("value", F.lit(1.0)), "value", {"units": "K"})
    df = store.attach_attrs(df, "value", {"interpolation_to": "gcm"})
    assert df.schema["value"].metadata == {"units": "K", "interpolation_to": "gcm"}
    path = str(tmp_path / "attrs")
    store.write_attrs(store.attrs_table(spark, "ta", {"units": "K"}), path)
    assert spark.read.parquet(path).count() == 1


def test_stored_job_end_to_end(spark, tmp_path):
    """A linear atmosphere comes back exactly, and the target's values fill the top."""
    source, target = str(tmp_path / "in"), str(tmp_path / "gcm")
    out, cache = str(tmp_path / "out"), str(tmp_path / "weights")

    def height(k):
        return 100.0 * (k + 1)

    value = lambda k, a, b: 2.0 * height(k) + a
    store.write_field(small_field(spark, "t", value), source)
    store.write_field(small_field(spark, "u", value), source)
    store.write_field(small_field(spark, "z", lambda k, a, b: 9.80665 * height(k)), source)
    store.write_field(small_field(spark, "q", lambda k, a, b: 3.0), source)
    lats, lons = (5.0, 12.0), (2.5, 7.5)
    for var in ("ta", "ua", "hus"):
        store.write_field(small_field(spark, var, lambda k, a, b: -5.0, lats=lats, lons=lons, levels=3), target)
    xs = {0: 50.0, 1: 250.0, 2: 900.0}
    mass_lats, mass_lons = (4.0, 14.0), (2.0, 8.0)
    zfull = spark.createDataFrame(
        [(a, b, k, x) for a in mass_lats for b in mass_lons for k, x in xs.items()],
        "lat double, lon double, lev_idx int, zfull double",
    )
    same = spark.createDataFrame(
        [(a, b, k, x) for a in lats for b in lons for k, x in xs.items()],
        "lat double, lon double, lev_idx int, zfull double",
    )
    job = jobs.Job(
        source, source, target, out, cache, ("ta", "hus"), years=(2000, 2000),
        box=selection.Box(0.0, 50.0, 0.0, 50.0), target_name="gcm",
    )
    jobs.run_interpolation(spark, job, same)
    jobs.run_interpolation(spark, jobs.Job(**{**job.__dict__, "target_vars": ("ua",)}), zfull)
    for var in ("ta", "ua", "hus"):
        rows = fields.scan_field(spark, out, var).collect()
        assert len(rows) == 2 * 2 * 3 * 4
        for r in rows:
            below = 3.0 if var == "hus" else 2.0 * xs[r["lev_idx"]] + r["lat"]
            want = -5.0 if r["lev_idx"] == 2 else below
            assert r["value"] == pytest.approx(want), (var, r)
            assert r["lev"] == r["lev_idx"]
    attrs = spark.read.parquet(out + "_attrs").collect()
    assert {(r["var"], r["key"], r["value"]) for r in attrs} == {
        (var, "interpolation_to", "gcm") for var in ("ta", "ua", "hus")
    }
    with pytest.raises(ValueError):  # a target month without input
        store.write_field(
            small_field(spark, "ta", lambda k, a, b: 1.0, (7,), lats, lons, levels=3), target
        )
        jobs.run_interpolation(spark, job, same)


def test_one_pass_over_the_geopotential(spark, tmp_path):
    """Variables of one target grid are one plan: it reads and regrids the geopotential once."""
    paths = [str(tmp_path / n) for n in ("in", "gcm", "out", "w")]
    for k, var in enumerate(("t", "q", "u", "v", "z")):
        store.write_field(small_field(spark, var, lambda lev, a, b, k=k: 10.0 * lev + k), paths[0])
    for var in ("ta", "hus", "ua", "va"):
        store.write_field(
            small_field(spark, var, lambda k, a, b: 0.0, lats=(5.0, 12.0), lons=(2.5, 7.5), levels=2), paths[1]
        )
    zfull = spark.createDataFrame(
        [(a, b, k, 1.0 + k) for a in (4.0, 14.0) for b in (2.0, 8.0) for k in (0, 1)],
        "lat double, lon double, lev_idx int, zfull double",
    )
    job = jobs.Job(paths[0], paths[0], paths[1], paths[2], paths[3], years=(2000, 2000))
    groups = list(jobs.plan_interpolation(spark, job, zfull))
    assert [g.variables for g in groups] == [("hus", "ta"), ("ua", "va")]
    for group in groups:
        plan = group.result._jdf.queryExecution().sparkPlan().toString()
        scans = [line for line in plan.splitlines() if "FileScan" in line and "PartitionFilters" in line]
        assert sum("= z)" in line for line in scans) == 1
        # one aggregation for all sums, and heights
        assert plan.count("sum(") >= 3


def test_variables_of_a_run_do_not_touch_each_other(spark, tmp_path):
    """A run of two variables gives what two runs give, also where one of them lacks values."""
    paths = [str(tmp_path / n) for n in ("in", "gcm", "out", "w")]
    store.write_field(small_field(spark, "t", lambda k, a, b: k + a), paths[0])
    store.write_field(small_field(spark, "q", lambda k, a, b: float("nan") if k == 1 else 2.0 * k), paths[0])
    store.write_field(small_field(spark, "z", lambda k, a, b: 9.80665 * 10 * k), paths[0])
    for var in ("ta", "hus"):
        store.write_field(
            small_field(spark, var, lambda k, a, b: -1.0, lats=(5.0,), lons=(5.0,), levels=2), paths[1]
        )
    zfull = spark.createDataFrame(
        [(5.0, 5.0, 0, 5.0), (5.0, 5.0, 1, 15.0)], "lat double, lon double, lev_idx int, zfull double"
    )
    job = jobs.Job(paths[0], paths[0], paths[1], paths[2], paths[3], ("ta", "hus"), years=(2000, 2000))
    jobs.run_interpolation(spark, job, zfull)
    for var in job.target_vars:
        alone = jobs.Job(**{**job.__dict__, "target_vars": (var,), "output_path": f"{paths[2]}_{var}"})
        jobs.run_interpolation(spark, alone, zfull)
        both, one = (
            sorted(map(str, fields.scan_field(spark, p, var).collect())) for p in (paths[2], alone.output_path)
        )
        assert both == one and both
    with pytest.raises(ValueError, match="same times"):
        late = small_field(spark, "t", lambda k, a, b: 1.0, (8,))
        store.write_field(late, paths[0])
        store.write_field(small_field(spark, "q", lambda k, a, b: 1.0, (8,)), paths[0])
        store.write_field(small_field(spark, "z", lambda k, a, b: 1.0, (8,)), paths[0])
        list(jobs.plan_interpolation(spark, job, zfull))


def test_kinds_of_levels_of_a_stored_target(spark, tmp_path):
    path = str(tmp_path / "gcm")
    levels = spark.createDataFrame([(0, 0.0, 1.0), (1, 0.0, 0.5)], "lev_idx int, ap double, b double")
    sigma = "atmosphere_hybrid_sigma_pressure_coordinate"
    with_t = small_field(spark, "ta", lambda k, a, b: 250.0, levels=2)
    store.write_field(with_t, path)
    store.write_field(small_field(spark, "ps", lambda k, a, b: 1e5, levels=1), path)
    store.write_field(small_field(spark, "hus", lambda k, a, b: 0.01, levels=2), path)
    store.write_levels(levels, "ta", sigma, f"{path}_levels")
    store.write_levels(levels.select("lev_idx"), "old", "some other coordinate", f"{path}_levels")
    dry = heights.stored_heights(spark, path, "ta", (2000, 2000)).collect()
    thick = 287.05 / 9.80665 * 250.0 * math.log(2)
    assert len(dry) == with_t.count()
    assert all(r["zfull"] == pytest.approx(thick if r["lev_idx"] else 0.0) for r in dry)
    moist = heights.stored_heights(spark, path, "ta", (2000, 2000), q="hus").collect()
    assert len(moist) == len(dry)
    assert {round(r["zfull"], 6) for r in moist if r["lev_idx"]} == {round(thick * (1 + 0.609133 * 0.01), 6)}
    few = heights.stored_heights(spark, path, "ta", (2000, 2000), selection.Box(0.0, 5.0, 0.0, 5.0))
    assert {(r["lat"], r["lon"]) for r in few.collect()} == {(0.0, 0.0)}
    static = small_field(spark, "zfull", lambda k, a, b: 7.0 * k, levels=2).drop("time", "year", "month").distinct()
    store.write_static(static, str(tmp_path / "fx"))
    store.write_levels(levels.select("lev_idx"), "ua", "hybrid height coordinate", f"{path}_levels")
    fixed = heights.stored_heights(spark, path, "ua", heights_path=str(tmp_path / "fx"))
    assert "time" not in fixed.columns and {(r["lev_idx"], r["zfull"]) for r in fixed.collect()} == {(0, 0.0), (1, 7.0)}
    for var, why in (("va", "no kinds"), ("old", "unknown vertical"), ("ua", "need the static")):
        with pytest.raises(ValueError, match=why):
            heights.stored_heights(spark, path, var)


def test_reformat_restores_names(spark, tmp_path):
    path = str(tmp_path / "back")
    store.reformat(small_field(spark, "t", lambda k, a, b: 1.0), {"t": "ta"}, {"units": "K"}, path)
    assert fields.scan_field(spark, path, "ta").count() == 144
    assert spark.read.parquet(path + "_attrs").first()["var"] == "ta"


def test_gcm_input_keeps_its_names(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("in", "gcm", "out", "w")]
    store.write_field(small_field(spark, "ta", lambda k, a, b: k + a), paths[0])
    store.write_field(small_field(spark, "zg", lambda k, a, b: 9.80665 * 10 * k), paths[0])
    store.write_field(small_field(spark, "ta", lambda k, a, b: 0.0, lats=(5.0,), lons=(5.0,), levels=1), paths[1])
    zfull = spark.createDataFrame([(5.0, 5.0, 0, 15.0)], "lat double, lon double, lev_idx int, zfull double")
    job = jobs.Job(
        paths[0], paths[0], paths[1], paths[2], paths[3], ("ta",), input_model="gcm",
        geopotential_var="zg", years=(2000, 2000), strict=False,
    )
    jobs.run_interpolation(spark, job, zfull)
    assert {round(r["value"], 9) for r in fields.scan_field(spark, paths[2], "ta").collect()} == {6.5}


def test_stored_surface_job(spark, tmp_path):
    source, target, out = (str(tmp_path / n) for n in ("in", "ocean", "out"))
    sst = small_field(spark, "sst", lambda k, a, b: a + b, months=(1, 3), levels=1)
    store.write_field(sst.withColumn("lev_idx", F.lit(None).cast("int")), source)
    tos = small_field(spark, "tos", lambda k, a, b: 0.0, months=(5,), lats=(5.0, 60.0), lons=(5.0,), levels=1)
    store.write_field(tos, target)
    job = jobs.Job(source, source, target, out, str(tmp_path / "w"), years=(2000, 2000))
    missing = jobs.run_surface(spark, job)
    assert sorted(r["month"] for r in missing.collect()) == [2, 4, 5, 6, 7, 8, 9, 10, 11, 12]
    rows = fields.scan_field(spark, out, "tos").collect()
    assert len(rows) == 8
    assert {(r["lat"], r["value"]) for r in rows} == {(5.0, 10.0), (60.0, None)}


def test_strict_times(spark):
    src = small_field(spark, "t", lambda k, a, b: 1.0).withColumn("geopotential", F.col("lev") * 10)
    tgt = small_field(spark, "ta", lambda k, a, b: 1.0, months=(1,))
    zfull = heights.with_cells(tgt.selectExpr("lev_idx", "lat", "lon", "lev AS zfull").distinct())
    with pytest.raises(ValueError):
        jobs.interpolate_and_fill(src, tgt, zfull, strict=True)


def test_another_grid_is_an_error(spark):
    """Weights of one grid meet no cell of another: not a silent fill with the target's values."""
    src = small_field(spark, "t", lambda k, a, b: 1.0).withColumn("geopotential", F.col("lev") * 10)
    tgt = small_field(spark, "ta", lambda k, a, b: 1.0)
    zfull = heights.with_cells(tgt.selectExpr("lev_idx", "lat", "lon", "lev AS zfull").distinct())
    away = src.drop("value").withColumn("lat", F.col("lat") + 0.5)
    w = jobs.build_weights("bilinear", src, tgt)
    with pytest.raises(ValueError, match="geopotential"):
        jobs.interpolate_and_fill(
            src.drop("geopotential"), tgt, zfull, weights={"bilinear": w}, geopotential=away,
            geopotential_weights=w,
        )


def test_staggered_geopotential_and_own_coordinates(spark):
    """Values linear in height come out right, at the target's fractional and negative coordinates."""
    axes = {"lats": (0.0, 10.0, 20.0), "lons": (0.0, 10.0, 20.0, 350.0)}
    lev = small_field(spark, "t", lambda k, a, b: 3.0 * k, **axes)
    geo = small_field(spark, "z", lambda k, a, b: 9.80665 * 10 * k, lats=(1.0, 11.0, 21.0), lons=(-8.0, 2.5, 13.0))
    geo = geo.withColumnRenamed("value", "geopotential")
    tgt = small_field(
        spark, "ta", lambda k, a, b: -999.0, lats=(8.57216851400727,), lons=(-3.123456789, 7.25), levels=1
    )
    zfull = heights.with_cells(tgt.selectExpr("lev_idx", "lat", "lon", "15D AS zfull").distinct())
    out = jobs.interpolate_and_fill(lev, tgt, zfull, geopotential=geo, periodic=True)
    assert {round(r["value"], 9) for r in out.collect()} == {4.5}
    assert out.join(tgt.select("time", "lev_idx", "lat", "lon"), ["time", "lev_idx", "lat", "lon"]).count() == tgt.count()


def test_input_attributes_are_copied(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("in", "gcm", "out", "w")]
    store.write_field(small_field(spark, "ta", lambda k, a, b: k + a), paths[0])
    store.write_field(small_field(spark, "zg", lambda k, a, b: 9.80665 * 10 * k), paths[0])
    store.write_attrs(store.attrs_table(spark, "ta", {"units": "K"}), paths[0] + "_attrs")
    store.write_field(small_field(spark, "ta", lambda k, a, b: 0.0), paths[1])
    zfull = fields.scan_field(spark, paths[1], "ta").selectExpr("lat", "lon", "lev_idx", "15D AS zfull").distinct()
    job = jobs.Job(paths[0], *paths, ("ta",), input_model="gcm", geopotential_var="zg", years=(2000, 2000))
    jobs.run_interpolation(spark, job, zfull)
    rows = spark.read.parquet(paths[2] + "_attrs").collect()
    assert {(r["key"], r["value"]) for r in rows} == {("units", "K"), ("interpolation_to", "gcm")}


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return "spark://host:7077" if key == "spark.master" else default

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="checkpoint"):
        store.shared_folder(Session(), "x")


def test_360_day_and_all_leap(spark):
    df = spark.createDataFrame([(float(d),) for d in (0, 59, 359, 360, -1)], "time double")
    part = lambda c: [
        tuple(r) for r in df.select(*calendars.decode_time_parts(F.col("time"), "days since 2001-01-01", c).values()).collect()
    ]
    assert part("360_day") == [(2001, 1, 1, 0), (2001, 2, 30, 0), (2001, 12, 30, 0), (2002, 1, 1, 0), (2000, 12, 30, 0)]
    assert part("all_leap") == [(2001, 1, 1, 0), (2001, 2, 29, 0), (2001, 12, 25, 0), (2001, 12, 26, 0), (2000, 12, 31, 0)]


def test_noleap_has_no_29_february(spark):
    df = spark.createDataFrame([(float(d),) for d in (58, 59, 365, -1)], "time double")
    out = fields.decode_cf(df, "days since 2000-01-01", "365_day").collect()
    assert [r["time"] for r in out] == [
        dt.datetime(2000, 2, 28), dt.datetime(2000, 3, 1), dt.datetime(2001, 1, 1), dt.datetime(1999, 12, 31)
    ]
    std = fields.decode_cf(df, "days since 2000-01-01").collect()
    assert std[1]["time"] == dt.datetime(2000, 2, 29)
    with pytest.raises(ValueError):
        fields.decode_cf(df, "days since 2000-01-01", "lunar")
    with pytest.raises(ValueError):
        fields.decode_cf(df, "fortnights since 2000-01-01")


def test_stored_first_version(spark, tmp_path):
    """Two variables in one run; lines go on at both ends; other cells or months are an error."""
    source = str(tmp_path / "in")
    height = lambda k: 100.0 * (k + 1)
    store.write_field(small_field(spark, "t", lambda k, a, b: 2.0 * height(k) + a), source)
    store.write_field(small_field(spark, "q", lambda k, a, b: height(k)), source)
    store.write_field(small_field(spark, "z", lambda k, a, b: 9.80665 * height(k)), source)
    store.write_field(small_field(spark, "u", lambda k, a, b: 1.0, lats=(0.0, 10.0)), source)
    store.write_field(small_field(spark, "v", lambda k, a, b: 1.0, months=(1,)), source)
    xs = {0: 50.0, 1: 250.0, 2: 900.0}
    levels = spark.createDataFrame(
        [(a, b, k, x) for a in (5.0, 12.0) for b in (2.5, 7.5) for k, x in xs.items()],
        "lat double, lon double, lev_idx int, zfull double",
    )
    job = jobs.Job(
        source, source, str(tmp_path / "none"), str(tmp_path / "out"), str(tmp_path / "weights"), ("ta", "hus"),
        years=(2000, 2000),
    )
    jobs.run_levels(spark, job, levels)
    for var in ("ta", "hus"):
        rows = fields.scan_field(spark, job.output_path, var).collect()
        assert len(rows) == 2 * 2 * 3 * 4
        for r in rows:
            x = xs[r["lev_idx"]]
            assert r["value"] == pytest.approx(x if var == "hus" else 2.0 * x + r["lat"])
    for var in ("ua", "va"):
        with pytest.raises(ValueError, match="cells" if var == "ua" else "months"):
            jobs.run_levels(spark, jobs.Job(**{**job.__dict__, "target_vars": (var,)}), levels)


def hourly_field(spark, cells):
    """One day with 24 hours of ``cells`` cells, in no order."""
    return spark.range(24 * cells, numPartitions=4).selectExpr(
        "TIMESTAMP_NTZ'2000-01-01' + make_interval(0, 0, 0, 0, id % 24) AS time", "0 AS lev_idx", "0D AS lev",
        "0D AS lat", "CAST(id DIV 24 AS DOUBLE) / 1000 AS lon", "CAST(id AS DOUBLE) AS value",
        "'t' AS var", "2000 AS year", "1 AS month",
    )


def rows_of_scan(df):
    """Rows the scan of a plan without exchange gave to the next operator, and its description."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().get("numOutputRows").get().value(), leaf.toString()


def test_other_hours_are_left_out_by_the_scan(spark, tmp_path):
    path = str(tmp_path / "hourly")
    store.write_field(hourly_field(spark, 40_000), path)
    df = fields.scan_field(spark, path, "t", hours=(0, 6, 12, 18))
    read, scan = rows_of_scan(df.selectExpr("time", "value").where("value < 24"))
    assert "PushedFilters: [Or(In(hour, " in scan
    assert read < 24 * 40_000 / 2.5  # a sixth, and the other rows of pages that two hours share
    assert df.count() == 4 * 40_000
    assert {r["h"] for r in df.selectExpr("hour(time) AS h").distinct().collect()} == {0, 6, 12, 18}


def test_hours_of_files_without_the_stored_hour(spark, tmp_path):
    path = str(tmp_path / "old")
    hourly_field(spark, 5).write.partitionBy("var", "year", "month").parquet(path)
    df = fields.scan_field(spark, path, "t", hours=(0, 6))
    assert df.count() == 10 and "hour" not in df.columns
    assert fields.scan_field(spark, path, "t").count() == 120


def test_stored_order_finds_misplaced_rows(spark, tmp_path):
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    store.write_field(hourly_field(spark, 50), good)
    store.write_field(hourly_field(spark, 50).withColumn("var", F.expr("if(value % 2 < 1, 'u', 'v')")), good)
    assert [r["misplaced"] for r in store.stored_order(spark, good).collect()] == [0, 0, 0]
    hourly_field(spark, 50).coalesce(1).write.partitionBy("var", "year", "month").parquet(bad)
    row = store.stored_order(spark, bad).first()
    assert row["n"] == 1200 and row["misplaced"] > 0


def test_months_come_from_the_list_of_files(spark, tmp_path):
    path = str(tmp_path / "named")
    odd = "a b/ä=%1"  # escaped in the names of folders
    for var, month in ((odd, 3), ("t", 1)):
        store.write_field(
            hourly_field(spark, 2).withColumns({"var": F.lit(var), "month": F.lit(month)}), path
        )
    assert [tuple(r) for r in fields.available_months(spark, path, odd).collect()] == [(2000, 3)]
    assert [tuple(r) for r in fields.available_months(spark, path, "t").collect()] == [(2000, 1)]
    assert fields.available_months(spark, path, "absent").collect() == []


def test_catalogue_follows_the_files(spark, tmp_path, monkeypatch):
    """Only months with other files than before are read, and all there is shows."""
    path, base = str(tmp_path / "field"), str(tmp_path / "base")
    learned, learn = [], catalogues._learn
    monkeypatch.setattr(catalogues, "_learn", lambda *a: (learned.append(sorted(a[-1])), learn(*a)))

    def known(years=None, var="t"):
        entry = catalogues.catalogue(spark, path, var, base, years)
        cells = sorted((r["lat"], r["lon"]) for r in entry.cells.collect())
        return cells, sorted(r["time"] for r in entry.times.collect())

    field = lambda months, lats: small_field(spark, "t", lambda k, a, b: 1.0, months, lats=lats, lons=(5.0,))
    store.write_field(field((1, 2), (0.0, 10.0)), path)
    cells, times = known()
    assert cells == [(0.0, 5.0), (10.0, 5.0)] and len(times) == len(set(times)) > 0
    assert known() == (cells, times) and learned == [[(2000, 1), (2000, 2)]]
    # a month written again, with a cell of its own, and a new one
    store.write_field(field((2, 3), (20.0,)), path)
    again, later = known()
    assert again == [(0.0, 5.0), (10.0, 5.0), (20.0, 5.0)] and len(later) > len(times)
    assert learned[1:] == [[(2000, 2), (2000, 3)]]
    store.write_field(field((1,), (20.0,)), path)
    assert known()[0] == [(20.0, 5.0)]
    assert known((1990, 1999)) == ([], []) and known(var="absent") == ([], []) and len(learned) == 3
    want = grids.scan_grid(fields.scan_field(spark, path, "t")).collect()
    assert sorted(map(str, catalogues.catalogue(spark, path, "t", base).cells.collect())) == sorted(map(str, want))


def test_catalogue_of_rows_without_place(spark, tmp_path):
    path, base = str(tmp_path / "field"), str(tmp_path / "base")
    store.write_field(hourly_field(spark, 1).withColumn("lat", F.lit(None).cast("double")), path)
    entry = catalogues.catalogue(spark, path, "t", base)
    assert entry.cells.count() == 0 and entry.times.count() == 24


def test_strict_checks_read_no_field(spark, tmp_path, monkeypatch):
    """With the catalogue made, a strict run is planned without a pass over a field."""
    paths = [str(tmp_path / n) for n in ("in", "gcm", "out", "w")]
    store.write_field(small_field(spark, "ta", lambda k, a, b: k + a), paths[0])
    store.write_field(small_field(spark, "zg", lambda k, a, b: 9.80665 * 10 * k), paths[0])
    store.write_field(small_field(spark, "ta", lambda k, a, b: 0.0, lats=(5.0,), lons=(5.0,), levels=1), paths[1])
    zfull = spark.createDataFrame([(5.0, 5.0, 0, 15.0)], "lat double, lon double, lev_idx int, zfull double")
    job = jobs.Job(*paths[:1], *paths, ("ta",), input_model="gcm", geopotential_var="zg", years=(2000, 2000))
    list(jobs.plan_interpolation(spark, job, zfull))
    # a plan over values that cannot be read: only running it would fail
    read = jobs.scan_field
    broken = F.raise_error(F.lit("a field was read")).cast("double")
    monkeypatch.setattr(jobs, "scan_field", lambda *a, **k: read(*a, **k).withColumns(
        {"time": F.expr("CAST(raise_error('a field was read') AS TIMESTAMP_NTZ)"), "lat": broken}
    ))
    assert [g.variables for g in jobs.plan_interpolation(spark, job, zfull)] == [("ta",)]
