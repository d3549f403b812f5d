"""Putting fields together by their coordinates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_coords(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Coordinates that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def combine_by_coords(
    pieces: Sequence[DataFrame], keys: Sequence[str], check: bool = True
) -> DataFrame:
    """One field out of several pieces. Overlapping pieces are an error when checked.

    The check first looks only at the first key (time): pieces without a common time cannot
    overlap. Whole coordinates are compared just for the times that several pieces have.
    """
    whole = reduce(lambda a, b: a.unionByName(b), pieces)
    if check and len(pieces) > 1:
        first = keys[0]
        each = [p.select(first).distinct() for p in pieces]
        shared = duplicate_coords(reduce(lambda a, b: a.unionByName(b), each), [first])
        if not shared.isEmpty():
            again = whole.select(*keys).join(shared.select(first), first, "left_semi")
            if not duplicate_coords(again, keys).isEmpty():
                raise ValueError("pieces overlap: a coordinate occurs more than once")
    return whole


def stack_variables(fields: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Several one-variable fields as one table with a column per variable.

    A point gets one row per variable, NULL in the other columns. The aggregation of the next
    step merges them, so no join is needed to bring variables together.
    """
    names = list(fields)
    parts = [
        df.selectExpr(
            *keys,
            *[f"{'value' if n == name else 'CAST(NULL AS DOUBLE)'} AS {n}" for n in names],
        )
        for name, df in fields.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def unmatched(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Coordinates of only one side, labelled ``left`` or ``right``; one aggregation, no join."""
    sides = left.selectExpr(*on, "'left' AS _side").unionByName(
        right.selectExpr(*on, "'right' AS _side")
    )
    seen = sides.groupBy(*on).agg(F.expr("min(_side) AS side"), F.expr("max(_side) AS _other"))
    return seen.where("side = _other").drop("_other")


def align_exact(
    left: DataFrame, right: DataFrame, on: Sequence[str], strict: bool = False
) -> DataFrame:
    """Inner join on coordinates. ``strict`` raises when either side has extra coordinates."""
    if strict and not unmatched(left, right, on).isEmpty():
        raise ValueError(f"coordinates differ on {list(on)}")
    return left.join(right, list(on), "inner")


def fill_from(
    df: DataFrame, other: DataFrame, on: Sequence[str], value: str = "value"
) -> DataFrame:
    """Replace missing values by those of another field at the same coordinates."""
    filler = other.selectExpr(*on, f"{value} AS _fill")
    return df.join(filler, list(on), "left").withColumn(
        value, F.coalesce(value, "_fill")
    ).drop("_fill")


def require_nonempty(df: DataFrame, what: str) -> DataFrame:
    """Raise when there are no rows (reads at most one)."""
    if df.isEmpty():
        raise ValueError(f"nothing to read: {what}")
    return df


def missing_months(available: DataFrame, start_year: int, end_year: int) -> DataFrame:
    """Months of the years start..end that ``available`` (year, month) does not have."""
    spark = available.sparkSession
    wanted = (
        spark.range(start_year, end_year + 1)
        .selectExpr("CAST(id AS INT) AS year", "explode(sequence(1, 12)) AS month")
    )
    have = available.select("year", "month").distinct()
    return wanted.join(have, ["year", "month"], "left_anti")
