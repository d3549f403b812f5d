"""Declared schemas of the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

FIELD = T.StructType(
    [
        T.StructField("time", T.TimestampNTZType()),
        T.StructField("lev_idx", T.IntegerType()),
        T.StructField("lev", T.DoubleType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("var", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
    ]
)

# as stored: the hour of day is a column of the files, whose statistics let scans skip other hours
STORED_FIELD = T.StructType(
    [*FIELD.fields[:6], T.StructField("hour", T.IntegerType()), *FIELD.fields[6:]]
)

STATIC_FIELD = T.StructType(
    [
        T.StructField("lev_idx", T.IntegerType()),
        T.StructField("lev", T.DoubleType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("var", T.StringType()),
    ]
)

WEIGHTS = T.StructType(
    [
        T.StructField("dst_id", T.LongType()),
        T.StructField("src_id", T.LongType()),
        T.StructField("w", T.DoubleType()),
        T.StructField("n_src", T.IntegerType()),
    ]
)

FIELD_ATTRS = T.StructType(
    [
        T.StructField("var", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)


LEVELS = T.StructType(
    [
        T.StructField("var", T.StringType()),
        T.StructField("standard_name", T.StringType()),
        T.StructField("lev_idx", T.IntegerType()),
        T.StructField("ap", T.DoubleType()),
        T.StructField("b", T.DoubleType()),
    ]
)


CATALOGUE_MONTHS = T.StructType(
    [
        T.StructField("files", T.StringType()),
        T.StructField("grid", T.StringType()),
        T.StructField("times", T.ArrayType(T.TimestampNTZType())),
        *FIELD.fields[6:],
    ]
)

CATALOGUE_CELLS = T.StructType(
    [
        T.StructField("dst_id", T.LongType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        *FIELD.fields[6:],
    ]
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to ``schema``; a missing column is an error."""
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {missing}")
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema])
