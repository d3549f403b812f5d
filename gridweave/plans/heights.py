"""Heights of the target model's levels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.functions import physics
from gridweave.functions.coords import cell_id
from gridweave.operators.regrid import regrid
from gridweave.operators.coordinates import clip_latitude, with_coordinates
from gridweave.operators.selection import Box, filter_bbox
from gridweave.operators.vertical import COLUMNS, hypsometric_heights
from gridweave.sources.fields import scan_field, scan_heights, scan_static
from gridweave.sources.store import read_levels

# Standard names of vertical coordinates
HYBRID_HEIGHT = ("atmosphere_hybrid_height_coordinate", "hybrid height coordinate")
HYBRID_SIGMA_PRESSURE = ("atmosphere_hybrid_sigma_pressure_coordinate",)


def with_cells(df: DataFrame) -> DataFrame:
    """Replace lat and lon by the cell id."""
    return df.withColumn("dst_id", F.expr(cell_id("lat", "lon"))).drop("lat", "lon")


def sigma_heights(
    model: DataFrame, coefficients: DataFrame, q: str | None = None, order: str = "lev_idx",
    columns: Sequence[str] = COLUMNS,
) -> DataFrame:
    """The rows of ``model`` with the height ``zfull`` of their hybrid sigma-pressure level.

    ``model`` has ``columns``, lev_idx, ``ta``, ``ps`` (repeated on every level) and, for moist
    heights, the column ``q``; other columns are kept. ``coefficients`` are lev_idx, ap, b.
    """
    # one map of a value per level: shuffling a field by its few level numbers would be badly skewed
    coef = coefficients.selectExpr(
        "map_from_entries(collect_list(struct(lev_idx, struct(ap, b)))) AS c"
    ).scalar()
    on_levels = (
        model.withColumn("_c", F.element_at(coef, F.col("lev_idx")))
        .where("_c IS NOT NULL")
        .withColumns({"ap": F.col("_c.ap"), "b": F.col("_c.b")})
        .drop("_c")
    )
    on_levels = on_levels.withColumn(
        "p", physics.hybrid_pressure(F.col("ap"), F.col("b"), F.col("ps"))
    )
    return hypsometric_heights(on_levels, "p", "ta", q, columns, order).drop("ap", "b", "p")


def target_heights(
    standard_name: str, static: DataFrame | None = None, model: DataFrame | None = None,
    coefficients: DataFrame | None = None, stored: DataFrame | None = None,
    q: str | None = None, order: str = "lev_idx",
) -> DataFrame:
    """Heights for the kind of vertical coordinate.

    Hybrid height: the static field. Hybrid sigma-pressure: stored heights when given, else
    computed from temperature and surface pressure.
    """
    if standard_name in HYBRID_HEIGHT:
        if static is None:
            raise ValueError("hybrid height levels need the static height field")
        return static
    if standard_name in HYBRID_SIGMA_PRESSURE:
        if stored is not None:
            return stored
        if model is None or coefficients is None:
            raise ValueError("sigma-pressure levels need temperature, pressure and coefficients")
        heights = sigma_heights(model, coefficients, q, order)
        return heights.select("time", "dst_id", "lev_idx", "zfull")
    raise ValueError(f"unknown vertical coordinate: {standard_name}")


def stored_heights(
    spark: SparkSession, target_path: str, var: str, years: tuple[int, int] | None = None,
    box: Box | None = None, heights_path: str | None = None, q: str | None = None,
    order: str = "lev_idx",
) -> DataFrame:
    """Heights lat, lon, lev_idx, zfull (and time) of the levels of a stored target variable.

    The kind of its levels is stored beside it (``write_levels``). Hybrid heights are the static field
    ``zfull`` of ``heights_path``. Heights of sigma-pressure levels are read from there, if it is given;
    else they are computed from the target's own ``ta`` and ``ps``, and its humidity ``q`` if that is
    named: all rows of a column meet in one exchange, by time and cell, in which pressure and
    humidity are stacked on the temperature, not joined.
    """
    levels = read_levels(spark, f"{target_path}_levels", var)
    kinds = [r["standard_name"] for r in levels.select("standard_name").distinct().limit(2).collect()]
    if len(kinds) != 1:
        raise ValueError(f"variable {var} has {'no' if not kinds else 'several'} kinds of levels in {target_path}_levels")

    def inside(df: DataFrame) -> DataFrame:
        df = clip_latitude(df)
        return filter_bbox(df, box) if box is not None else df

    if heights_path is not None:
        if kinds[0] in HYBRID_HEIGHT:
            stored = scan_static(spark, heights_path, "zfull").withColumnRenamed("value", "zfull")
            return inside(stored).select("lat", "lon", "lev_idx", "zfull")
        stored = scan_heights(spark, heights_path, "zfull", years)
        return target_heights(kinds[0], stored=inside(stored).select("time", "lat", "lon", "lev_idx", "zfull"))
    if kinds[0] not in HYBRID_SIGMA_PRESSURE:
        return target_heights(kinds[0])  # raises: nothing to take them from

    def part(name: str, column: str) -> DataFrame:
        df = with_cells(inside(scan_field(spark, target_path, name, years)))
        level = "lev_idx" if column != "ps" else "CAST(NULL AS INT) AS lev_idx"
        return df.selectExpr("time", "dst_id", level, f"value AS {column}")

    parts = [part("ta", "ta"), part("ps", "ps")] + ([part(q, "q")] if q else [])
    stacked = parts[0]
    for other in parts[1:]:
        stacked = stacked.unionByName(other, allowMissingColumns=True)
    # a column's rows lie together from here on: pressure is the value of the row without level, and
    # a level's temperature and humidity are merged within the column
    column = "PARTITION BY dst_id, time"
    model = (
        stacked.repartition("dst_id", "time")
        .selectExpr(
            "time", "dst_id", "lev_idx", f"max(ps) OVER ({column}) AS ps",
            f"max(ta) OVER ({column}, lev_idx) AS ta",
            *([f"max(q) OVER ({column}, lev_idx) AS q", "ta IS NOT NULL AS _level"] if q else ["true AS _level"]),
        )
        .where("lev_idx IS NOT NULL AND _level")
        .drop("_level")
    )
    made = target_heights(
        kinds[0], model=model, coefficients=levels.select("lev_idx", "ap", "b"), q="q" if q else None, order=order
    )
    return with_coordinates(made).drop("dst_id")


def regrid_heights(heights: DataFrame, weights: DataFrame, skip: bool = False) -> DataFrame:
    """Heights on the staggered grid of a wind component.

    ``heights`` has lat, lon, lev_idx, zfull and maybe time. ``skip`` returns them unchanged.
    """
    if skip:
        return with_cells(heights)
    by = [c for c in ("time", "lev_idx") if c in heights.columns]
    return regrid(heights, weights, ["zfull"], by)
