"""Scans.

Stored fields are Parquet partitioned by ``var``, ``year`` and ``month``: the file layout of one
file per variable and month. Filters on those columns prune files, and the declared schema
means no file is opened to learn its columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave import schema
from gridweave.functions.calendars import decode_packed, decode_time, decode_time_parts
from gridweave.functions.coords import nan_to_null
from gridweave.operators.align import combine_by_coords, missing_months
from gridweave.operators.selection import filter_synoptic, filter_years


def scan_field(
    spark: SparkSession, paths: str | Sequence[str], var: str,
    years: tuple[int, int] | None = None, months: Sequence[int] | None = None,
    hours: Sequence[int] | None = None,
) -> DataFrame:
    """One variable of one or several stored fields; several must not overlap.

    ``hours`` keeps rows of these hours of day. The stored hour is compared in the scan, which leaves
    out parts of files that have other hours only; files stored without it are read whole.
    """
    roots = [paths] if isinstance(paths, str) else list(paths)
    pieces = []
    for root in roots:
        df = spark.read.schema(schema.STORED_FIELD).parquet(root).where(F.col("var") == var)
        if hours is not None:
            df = df.where(F.col("hour").isin(list(hours)) | F.col("hour").isNull())
            df = filter_synoptic(df, hours)
        df = df.drop("hour")
        if years is not None:
            df = filter_years(df, *years)
        if months is not None:
            df = df.where(F.col("month").isin(list(months)))
        pieces.append(df)
    field = combine_by_coords(pieces, ["time", "lev_idx", "lat", "lon"])
    return field.withColumn("value", F.expr(nan_to_null("value")))


def scan_static(spark: SparkSession, path: str, var: str) -> DataFrame:
    """A field without time."""
    df = spark.read.schema(schema.STATIC_FIELD).parquet(path).where(F.col("var") == var)
    return df.withColumn("value", F.expr(nan_to_null("value")))


def scan_heights(
    spark: SparkSession, path: str, var: str, years: tuple[int, int] | None = None,
    months: Sequence[int] | None = None,
) -> DataFrame:
    """Stored geopotential height of the target model, with the value named ``zfull``."""
    return scan_field(spark, path, var, years, months).withColumnRenamed("value", "zfull")


def available_months(spark: SparkSession, path: str, var: str) -> DataFrame:
    """Months (year, month) a variable has files for, from the list of files: none is opened."""
    return spark.createDataFrame(sorted(stored_files(spark, path, var)), "year INT, month INT")


def stored_files(spark: SparkSession, path: str, var: str) -> dict[tuple[int, int], list[str]]:
    """File names of a variable by (year, month), sorted, as Spark lists them to plan any read."""
    found: dict[tuple[int, int], list[str]] = {}
    for file in spark.read.schema(schema.STORED_FIELD).parquet(path).inputFiles():
        *folders, name = file.split("/")
        # names of folders are escaped once in the store and once in the address
        keys = dict(unquote(unquote(f)).split("=", 1) for f in folders[-3:] if "=" in unquote(f))
        year, month = keys.get("year", ""), keys.get("month", "")
        if keys.get("var") == var and year.isdigit() and month.isdigit():
            found.setdefault((int(year), int(month)), []).append(name)
    return {month: sorted(names) for month, names in found.items()}


def discover_months(
    spark: SparkSession, path: str, var: str, start_year: int, end_year: int
) -> DataFrame:
    """Months of the period without files; the surface job skips and reports them."""
    return missing_months(available_months(spark, path, var), start_year, end_year)


def decode_cf(
    df: DataFrame, units: str, calendar: str = "standard", time: str = "time",
    values: Sequence[str] = (), scale: float = 1.0, offset: float = 0.0,
    fill: float | None = None, parts: bool = False,
) -> DataFrame:
    """Encoded time and packed values to timestamps and doubles.

    ``parts`` also keeps year, month, day and second of day as columns, for joins between
    calendars.
    """
    columns = {v: decode_packed(F.col(v), scale, offset, fill) for v in values}
    if parts:
        columns |= decode_time_parts(F.col(time), units, calendar)
    columns[time] = decode_time(F.col(time), units, calendar)
    return df.withColumns(columns)
