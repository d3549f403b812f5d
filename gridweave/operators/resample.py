"""Time resampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridweave.functions.coords import nan_to_null


def resample_mean(
    df: DataFrame, every: str = "6 hours", by: Sequence[str] = ("lat", "lon"),
    values: Sequence[str] = ("value",), fill_gaps: bool = False,
) -> DataFrame:
    """Mean over bins that start at midnight, labelled by the start of the bin.

    Missing values are skipped. With ``fill_gaps`` every group has a row for every bin between
    the first and the last time of the whole field, NULL where it had no data. Only partial sums
    are shuffled, so a group with very many rows costs no more than others.
    """
    binned = df.selectExpr(
        f"window(time, '{every}').start AS _bin", *by,
        *[f"{nan_to_null(v)} AS {v}" for v in values],
    )
    if fill_gaps:
        # one empty row per bin and group, merged by the same aggregation instead of a join
        axis = binned.selectExpr(
            f"sequence(min(_bin), max(_bin), interval {every}) AS axis"
        ).scalar()
        spine = binned.select(*by).distinct().select(F.explode(axis).alias("_bin"), *by)
        binned = binned.unionByName(spine, allowMissingColumns=True)
    return binned.groupBy(F.col("_bin").alias("time"), *by).agg(
        *[F.expr(f"avg({v}) AS {v}") for v in values]
    )
