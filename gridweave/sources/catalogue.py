"""Catalogue of stored fields: cells and times of every variable and month.

Jobs need the cells of a field for its weights, and its times for their checks. Both are found once per
stored month, from the coordinate columns, and kept in two small tables. An entry names the files it was
made from, so a month that is written again, added or removed is found by the list of files, which Spark
has anyway; entries of other files count for nothing. Files are taken as never changed under their
name, as Spark writes them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave import schema
from gridweave.functions.coords import cell_id, clip_latitude
from gridweave.sources.fields import stored_files
from gridweave.sources.store import path_exists

Month = tuple[int, int]


@dataclass(frozen=True)
class Catalogue:
    """What a stored variable has: ``times`` (time) and ``cells`` (dst_id, lat, lon, as ``scan_grid``)."""

    times: DataFrame
    cells: DataFrame


def catalogue(
    spark: SparkSession, path: str, var: str, base: str, years: tuple[int, int] | None = None
) -> Catalogue:
    """Times and cells of a stored variable in a period, from the tables kept in ``base``.

    Months the tables do not know as they are now are read and added first. What reaches the driver is
    a row per month.
    """
    path = path.rstrip("/")
    place = f"{base}/catalogue/{hashlib.sha256(path.encode()).hexdigest()[:16]}"
    files = {
        month: hashlib.sha256("\n".join(names).encode()).hexdigest()
        for month, names in stored_files(spark, path, var).items()
        if years is None or years[0] <= month[0] <= years[1]
    }
    known = _entries(spark, place, var, files)
    lacking = {m: f for m, f in files.items() if m not in known}
    if lacking:
        _learn(spark, path, var, place, lacking)
        known = _entries(spark, place, var, files)
    # months with the same cells share their grid's name: one of them stands for all
    first: dict[str, Month] = {}
    for month in sorted(known):
        first.setdefault(known[month], month)
    return Catalogue(
        _of_months(_read(spark, place, "months", var), files).select(F.explode("times").alias("time")).distinct(),
        _of_months(_read(spark, place, "cells", var), first.values()).groupBy("dst_id").agg(
            F.min("lat").alias("lat"), F.min("lon").alias("lon")
        ),
    )


def _read(spark: SparkSession, place: str, table: str, var: str) -> DataFrame:
    kind = schema.CATALOGUE_MONTHS if table == "months" else schema.CATALOGUE_CELLS
    if not path_exists(spark, f"{place}/{table}"):
        return spark.createDataFrame([], kind)
    return spark.read.schema(kind).parquet(f"{place}/{table}").where(F.col("var") == var)


def _of_months(df: DataFrame, months) -> DataFrame:
    """Rows of some months; only their partitions are read."""
    return df.where((F.col("year") * 100 + F.col("month")).isin([100 * y + m for y, m in months]))


def _entries(spark: SparkSession, place: str, var: str, files: Mapping[Month, str]) -> dict[Month, str]:
    """Names of the grids of those months whose entries were made from the present files."""
    rows = _of_months(_read(spark, place, "months", var), files).select("year", "month", "files", "grid")
    return {
        (r["year"], r["month"]): r["grid"] for r in rows.collect() if files[r["year"], r["month"]] == r["files"]
    }


def _learn(spark: SparkSession, path: str, var: str, place: str, files: Mapping[Month, str]) -> None:
    """Write cells, then entries, of some months. Ended between the two, the months stay unknown."""
    rows = _of_months(spark.read.schema(schema.STORED_FIELD).parquet(path).where(F.col("var") == var), files)
    cells = rows.selectExpr(
        "var", "year", "month", f"{cell_id('lat', 'lon')} AS dst_id", f"{clip_latitude('lat')} AS lat", "lon"
    ).where("dst_id IS NOT NULL")
    cells = cells.groupBy("var", "year", "month", "dst_id").agg(F.min("lat").alias("lat"), F.min("lon").alias("lon"))
    _replace(schema.conform(cells, schema.CATALOGUE_CELLS), f"{place}/cells")
    grids = _of_months(_read(spark, place, "cells", var), files).groupBy("year", "month").agg(
        F.expr(
            "concat_ws('_', count(*), hex(bit_xor(xxhash64(dst_id))),"
            " sum(CAST(xxhash64(dst_id) AS DECIMAL(38, 0)))) AS grid"
        )
    )
    times = rows.groupBy("year", "month").agg(F.array_sort(F.collect_set("time")).alias("times"))
    listed = spark.createDataFrame(
        [(var, y, m, f) for (y, m), f in files.items()], "var STRING, year INT, month INT, files STRING"
    )
    # a month whose files hold no row has no times, one whose rows have no place no grid
    entries = listed.join(grids, ["year", "month"], "left").join(times, ["year", "month"], "left")
    entries = entries.withColumns(
        {"grid": F.coalesce("grid", F.lit("")), "times": F.expr("coalesce(times, CAST(array() AS ARRAY<TIMESTAMP_NTZ>))")}
    )
    _replace(schema.conform(entries, schema.CATALOGUE_MONTHS), f"{place}/months")


def _replace(df: DataFrame, path: str) -> None:
    (
        df.hint("rebalance", "var", "year", "month")
        .write.partitionBy("var", "year", "month")
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(path)
    )
