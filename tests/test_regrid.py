"""Properties of weights and regridding."""

import math

import pytest
from pyspark.sql import functions as F

from gridweave.functions.coords import cell_id, cell_lat, cell_lon
from gridweave.operators import grids, weights
from gridweave.operators.regrid import merge_weights, regrid, regrid_streams

SRC_LATS = [-90.0, -60.0, -35.0, 0.0, 20.0, 55.0, 90.0]
SRC_LONS = [float(x) for x in range(0, 360, 30)]
DST = [(-71.5, 10.0), (-60.0, 30.0), (3.25, 117.5), (89.0, 329.0), (90.0, 0.0), (-12.0, 345.0)]


def cells(spark, lats, lons):
    return spark.createDataFrame([(a, b) for a in lats for b in lons], "lat double, lon double")


def field(spark, fn, lats=SRC_LATS, lons=SRC_LONS):
    rows = [(1, 0, a, b, fn(a, b)) for a in lats for b in lons]
    return spark.createDataFrame(rows, "time int, lev_idx int, lat double, lon double, value double")


def points(spark, rows=DST):
    return grids.scan_grid(spark.createDataFrame(rows, "lat double, lon double"))


def by_cell(df, value="value"):
    out = df.selectExpr(f"{cell_lat('dst_id')} AS lat", f"{cell_lon('dst_id')} AS lon", value)
    return {(round(r["lat"], 6), round(r["lon"], 6)): r[value] for r in out.collect()}


def test_cell_ids_are_invertible_and_normalized(spark):
    rows = [(90.0000001, -10.0), (-90.0, 360.0), (12.345678, 359.9999999), (None, 1.0)]
    df = spark.createDataFrame(rows, "lat double, lon double").selectExpr(
        f"{cell_id('lat', 'lon')} AS id"
    )
    got = [
        (r[0], r[1])
        for r in df.selectExpr(cell_lat("id"), cell_lon("id")).collect()
    ]
    assert got[0] == (90.0, 350.0)
    assert got[1] == (-90.0, 0.0)
    assert got[2][0] == pytest.approx(12.345678, abs=1e-9) and got[2][1] == 0.0
    assert got[3] == (None, None)


def test_bilinear_reproduces_a_plane_and_leaves_out_the_outside(spark):
    plane = field(spark, lambda a, b: 3 + 0.5 * a - 0.25 * b)
    w = weights.build_weights("bilinear", plane, None, points(spark))
    got = by_cell(regrid(plane, w))
    want = {p: 3 + 0.5 * p[0] - 0.25 * p[1] for p in DST if p[1] <= 330}
    assert set(got) == set(want)
    assert all(got[p] == pytest.approx(want[p], abs=1e-9) for p in want)


def test_patch_reproduces_a_parabola_inside(spark):
    bowl = field(spark, lambda a, b: 0.01 * a * a + 0.002 * b * b - a * 0.3)
    w = weights.build_weights("patch", bowl, None, points(spark))
    got = by_cell(regrid(bowl, w))
    for p, v in got.items():
        assert v == pytest.approx(0.01 * p[0] ** 2 + 0.002 * p[1] ** 2 - 0.3 * p[0], abs=1e-7)


def test_periodic_bilinear_crosses_the_seam(spark):
    wave = field(spark, lambda a, b: min(b, 360 - b))
    w = weights.build_weights("bilinear", wave, None, points(spark), periodic=True)
    got = by_cell(regrid(wave, w))
    assert set(got) == set(DST)
    assert got[(-12.0, 345.0)] == pytest.approx(15.0)


def test_periodic_bilinear_before_the_first_longitude(spark):
    lons = [10.0 + 30 * i for i in range(12)]
    wave = field(spark, lambda a, b: 340.0 if b == 340 else b, lons=lons)
    w = weights.build_weights("bilinear", wave, None, points(spark, [(0.0, 2.0)]), periodic=True)
    # between 340 (-20) and 10: 22/30 of the way
    assert by_cell(regrid(wave, w))[(0.0, 2.0)] == pytest.approx(340 + (10 - 340) * 22 / 30)


@pytest.mark.parametrize("method", weights.METHODS)
def test_constant_stays_constant(spark, method):
    flat = field(spark, lambda a, b: 7.0)
    target = cells(spark, [-75.0, -45.0, -15.0, 15.0, 45.0, 75.0], [15.0 + 30 * i for i in range(11)])
    w = weights.build_weights(method, flat, target)
    sums = w.groupBy("dst_id").agg(F.sum("w").alias("s"), F.count("*").alias("n"), F.max("n_src").alias("m"))
    rows = sums.collect()
    assert rows and all(r["n"] == r["m"] for r in rows)
    got = by_cell(regrid(flat, w))
    if method == "nearest_d2s":
        assert sum(got.values()) == pytest.approx(7.0 * len(SRC_LATS) * len(SRC_LONS))
    else:
        assert all(v == pytest.approx(7.0) for v in got.values())


def test_conservative_keeps_the_area_integral(spark):
    src = field(spark, lambda a, b: 2 + math.sin(math.radians(a)) + 0.01 * b)
    target = cells(spark, [-67.5, -22.5, 22.5, 67.5], [22.5 + 45 * i for i in range(8)])
    w = weights.build_weights("conservative", src, target)
    got = regrid(src, w)

    def integral(df, lat, lon, value):
        lat_b = grids.axis_bounds(grids.grid_axes(df), "lats").selectExpr(
            "x AS _a", "sin(radians(hi)) - sin(radians(lo)) AS dy"
        )
        lon_b = grids.axis_bounds(grids.grid_axes(df), "lons").selectExpr("x AS _o", "hi - lo AS dx")
        joined = df.join(lat_b, F.abs(F.col(lat) - F.col("_a")) < 1e-6).join(
            lon_b, F.abs(F.col(lon) - F.col("_o")) < 1e-6
        )
        return joined.agg(F.sum(F.col(value) * F.col("dy") * F.col("dx"))).first()[0]

    out = got.selectExpr(f"{cell_lat('dst_id')} AS lat", f"{cell_lon('dst_id')} AS lon", "value")
    assert integral(out, "lat", "lon", "value") == pytest.approx(
        integral(src, "lat", "lon", "value"), rel=1e-9
    )


def test_conservative_partial_cover_and_norm(spark):
    src = cells(spark, [5.0, 15.0, 25.0], [5.0, 15.0])  # cells 0..30 x 0..20
    target = cells(spark, [10.0, 30.0], [10.0, 30.0])  # cells 20 degrees wide
    axes = weights.known_axes(src), weights.known_axes(target)
    for norm, total in (("dst", 0.5), ("frac", 1.0)):
        w = weights.weights_conservative(*axes, grids.scan_grid(target), norm)
        sums = by_cell(w.groupBy("dst_id").agg(F.sum("w").alias("value")))
        assert sums[(10.0, 10.0)] == pytest.approx(1.0)
        upper = (math.sin(math.radians(30)) - math.sin(math.radians(20))) / (
            math.sin(math.radians(40)) - math.sin(math.radians(20))
        )
        assert sums[(30.0, 10.0)] == pytest.approx(upper if norm == "dst" else 1.0)
        assert (10.0, 30.0) not in sums and total


def test_same_grid_is_identity(spark):
    src = field(spark, lambda a, b: a * 1000 + b)
    for method in ("bilinear", "nearest_s2d", "conservative"):
        w = weights.build_weights(method, src, src)
        got = by_cell(regrid(src, w))
        assert len(got) == len(SRC_LATS) * len(SRC_LONS)
        assert all(v == pytest.approx(a * 1000 + b) for (a, b), v in got.items())


def test_missing_source_makes_target_missing(spark):
    src = field(spark, lambda a, b: 1.0, [0.0, 10.0], [0.0, 10.0])
    grid = points(spark, [(5.0, 5.0), (0.0, 0.0), (10.0, 10.0)])
    w = weights.build_weights("bilinear", src, None, grid)
    absent = src.where("NOT (lat = 0 AND lon = 0)")
    null = src.withColumn("value", F.expr("CASE WHEN lat = 0 AND lon = 0 THEN NULL ELSE value END"))
    for holes in (absent, null):
        got = by_cell(regrid(holes, w))
        assert got[(5.0, 5.0)] is None and got[(10.0, 10.0)] == 1.0
        assert got.get((0.0, 0.0)) is None


def test_dense_grid_lists_unmapped_cells(spark):
    src = field(spark, lambda a, b: 1.0)
    grid = points(spark)
    out = by_cell(regrid(src, weights.build_weights("bilinear", src, None, grid), dense_grid=grid))
    assert set(out) == set(DST) and out[(-12.0, 345.0)] is None


def test_merged_weights_equal_separate_ones(spark):
    src = field(spark, lambda a, b: a + b).withColumn("other", F.col("value") * 2)
    target = cells(spark, [-75.0, -15.0, 45.0], [15.0, 75.0, 135.0])
    each = {m: weights.build_weights(m, src, target) for m in ("bilinear", "conservative")}
    both = regrid(src, merge_weights(each), {"value": "bilinear", "other": "conservative"})
    assert by_cell(both) == pytest.approx(by_cell(regrid(src, each["bilinear"])))
    assert by_cell(both, "other") == pytest.approx(
        by_cell(regrid(src, each["conservative"], ["other"]), "other")
    )


def test_nearest_near_a_pole(spark):
    """From (84, 44) the pole is nearer than (80, 0), the nearest values of latitude and longitude apart."""
    src = spark.createDataFrame(
        [(0, 0, lat, lon, lat) for lat in (80.0, 90.0) for lon in (0.0, 90.0, 180.0, 270.0)],
        "time int, lev_idx int, lat double, lon double, value double",
    )
    w = weights.build_weights("nearest_s2d", src, None, points(spark, [(84.0, 44.0), (81.0, 2.0)]))
    assert by_cell(regrid(src, w)) == {(84.0, 44.0): 90.0, (81.0, 2.0): 80.0}


def test_weights_are_joined_without_a_hint(spark):
    src = field(spark, lambda a, b: a + b)
    w = weights.build_weights("bilinear", src, None, points(spark))
    assert "strategy=broadcast" not in regrid(src, w)._jdf.queryExecution().analyzed().toString()


def test_fields_on_grids_of_their_own(spark):
    one = field(spark, lambda a, b: 2 * a + b)
    other = field(spark, lambda a, b: a - b).withColumnRenamed("value", "other")
    other = other.selectExpr("* except (lat, lon)", "lat * 0.5D AS lat", "lon * 0.5D + 1D AS lon")
    grid = points(spark, [(3.0, 4.0), (5.5, 7.25)])
    w, v = (weights.build_weights("bilinear", f, None, grid) for f in (one, other))
    both = regrid_streams([(one, w, ["value"]), (other, v, ["other"])])
    assert by_cell(both) == pytest.approx(by_cell(regrid(one, w)))
    assert by_cell(both, "other") == pytest.approx(by_cell(regrid(other, v, ["other"]), "other"))


def test_curvilinear_targets(spark):
    plane = field(spark, lambda a, b: 2 * a + b)
    twisted = [(0.1 * i + 0.01 * j, 3.0 * j + 0.2 * i) for i in range(10) for j in range(10)]
    w = weights.build_weights("bilinear", plane, None, points(spark, twisted))
    got = by_cell(regrid(plane, w))
    assert len(got) == 100
    assert all(v == pytest.approx(2 * a + b, abs=1e-5) for (a, b), v in got.items())


def test_scattered_points_are_no_source_grid(spark):
    points = spark.createDataFrame([(1.0, 1.0), (2.0, 5.0), (3.0, 3.0), (4.0, 9.0)], "lat double, lon double")
    target = spark.createDataFrame([(2.5, 4.0)], "lat double, lon double")
    with pytest.raises(Exception, match="not a rectilinear grid"):
        weights.build_weights("bilinear", points, target).collect()


def test_a_grid_with_missing_cells_is_still_a_grid(spark):
    cells = [(float(a), float(b)) for a in range(4) for b in range(4) if (a, b) != (2, 2)]
    source = spark.createDataFrame(cells, "lat double, lon double")
    target = spark.createDataFrame([(0.5, 0.5)], "lat double, lon double")
    assert weights.build_weights("bilinear", source, target).count() == 4
