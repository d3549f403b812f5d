"""Columns as arrays, and a function per column."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_profiles(
    df: DataFrame, columns: Sequence[str] = ("time", "dst_id"), value: str = "value"
) -> DataFrame:
    """One row per column with its values as an array of (lev_idx, value) in level order.

    An array has one element per level, so its length is that of the level axis.
    """
    return df.groupBy(*columns).agg(
        F.sort_array(F.collect_list(F.struct(F.col("lev_idx"), F.col(value).alias("value")))).alias(
            "profile"
        )
    )


def from_profiles(
    df: DataFrame, columns: Sequence[str] = ("time", "dst_id"), profile: str = "profile"
) -> DataFrame:
    """Inverse of ``to_profiles``."""
    return df.select(*columns, F.inline(profile))


def from_arrays(df: DataFrame, columns: Sequence[str], array: str) -> DataFrame:
    """Arrays of plain values to level rows; the position is ``lev_idx``."""
    rows = df.select(*columns, F.posexplode(array).alias("lev_idx", "value"))
    return rows.withColumn("value", F.col("value").cast("double"))


def apply_profile(
    df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str,
    columns: Sequence[str] = ("time", "dst_id"),
) -> DataFrame:
    """Call ``fn`` with the rows of one column at a time: the way out for custom column logic.

    ``schema`` is that of the rows ``fn`` returns.
    """
    return df.groupBy(*columns).applyInPandas(fn, schema)
