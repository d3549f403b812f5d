"""Filters on time, place and level."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SYNOPTIC_HOURS = (0, 6, 12, 18)  # fixed values


@dataclass(frozen=True)
class Box:
    """Inclusive latitude and longitude bounds."""

    lat_min: float
    lat_max: float
    lon_min: float
    lon_max: float


def filter_years(df: DataFrame, start: int, end: int) -> DataFrame:
    """Years start..end, both included. Prunes partitions when ``year`` is a column."""
    year = F.col("year") if "year" in df.columns else F.year("time")
    return df.where(year.between(start, end))


def filter_month(df: DataFrame, year: int, month: int) -> DataFrame:
    """One month. The partition columns, when present, prune files before the rows are tested."""
    if {"year", "month"} <= set(df.columns):
        df = df.where((F.col("year") == year) & (F.col("month") == month))
    return df.where((F.year("time") == year) & (F.month("time") == month))


def filter_synoptic(
    df: DataFrame, hours: Sequence[int] = SYNOPTIC_HOURS, time: str = "time"
) -> DataFrame:
    """Rows whose hour of day is one of ``hours``; minutes are not looked at."""
    return df.where(F.hour(time).isin(list(hours)))


def filter_bbox(df: DataFrame, box: Box) -> DataFrame:
    return df.where(
        F.col("lat").between(box.lat_min, box.lat_max)
        & F.col("lon").between(box.lon_min, box.lon_max)
    )


def level_slice(
    df: DataFrame, start: int | None = None, stop: int | None = None,
    by: Sequence[str] = ("time", "dst_id"),
) -> DataFrame:
    """Levels start..stop-1 of each column by position; negative positions count from the end."""
    order = Window.partitionBy(*by).orderBy("lev_idx")
    whole = Window.partitionBy(*by)
    ranked = df.withColumns(
        {"_pos": F.row_number().over(order) - 1, "_n": F.count(F.lit(1)).over(whole)}
    )

    def position(p: int):
        return F.lit(p) if p >= 0 else F.col("_n") + F.lit(p)

    if start is not None:
        ranked = ranked.where(F.col("_pos") >= position(start))
    if stop is not None:
        ranked = ranked.where(F.col("_pos") < position(stop))
    return ranked.drop("_pos", "_n")


def first_slice(df: DataFrame) -> DataFrame:
    """The map at the first time and the first level of that time."""
    first = df.agg(F.min(F.struct("time", "lev_idx")).alias("k"))
    here = df.join(
        F.broadcast(first.select("k.time", "k.lev_idx")), ["time", "lev_idx"], "left_semi"
    )
    return here
