"""Names, coordinates and final layout of fields."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridweave.functions import coords

# Short names, long names, variable names and their order
LONG_NAMES = {"lon": "longitude", "lat": "latitude", "lev": "level"}
STANDARD_DIMS = ("time", "lat", "lon", "lev")
# standard name, words that tell it, and the largest absolute value that tells it
DIM_RULES = (
    ("lat", ("lat",), 90),
    ("lon", ("lon",), 180),
    ("lev", ("lev", "level", "height", "depth"), None),
)
REANALYSIS_NAMES = {"hus": "q", "ta": "t", "ua": "u", "va": "v", "tos": "sst"}


def rename_vars(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename value columns; names not present are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def relabel_vars(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename variables held as values of the ``var`` column."""
    return df.replace(dict(mapping), subset=["var"])


def map_variable(target_var: str, input_model: str) -> str:
    """Name of a target variable in the input: reanalysis short name, or the same name."""
    if input_model == "gcm":
        return target_var
    if input_model == "reanalysis":
        return REANALYSIS_NAMES[target_var]
    raise ValueError(f"unknown input model: {input_model}")


def regrid_method(input_var: str) -> str:
    """Specific humidity keeps its area integral; everything else is interpolated."""
    return "conservative" if input_var == "q" else "bilinear"


def standardize_coords(df: DataFrame) -> DataFrame:
    """Long coordinate names. A short name beside an equal long one is dropped, else both stay.

    Reads the data only when both names exist.
    """
    both = [s for s, long in LONG_NAMES.items() if s in df.columns and long in df.columns]
    if both:
        equal = df.agg(
            *[F.bool_and(F.equal_null(F.col(s), F.col(LONG_NAMES[s]))).alias(s) for s in both]
        ).first()
        df = df.drop(*[s for s in both if equal[s] is not False])
    return df.withColumnsRenamed(
        {s: long for s, long in LONG_NAMES.items() if s in df.columns and s not in both}
    )


def standardize_dims(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Rename the unknown ones of ``dims`` after guessing what they are.

    The tests run in this order for each column: time type; latitude by name or by range;
    longitude by name or by range; level by name. Each standard name is given once.
    """
    unknown = [d for d in dims if d not in STANDARD_DIMS]
    types = {f.name: f.dataType for f in df.schema}
    times = [d for d in unknown if isinstance(types[d], (T.TimestampType, T.TimestampNTZType))]
    numeric = [d for d in unknown if isinstance(types[d], T.NumericType)]
    ranges = {}
    if numeric:
        row = df.agg(
            *[F.min(d).alias(f"{d}__lo") for d in numeric],
            *[F.max(d).alias(f"{d}__hi") for d in numeric],
        ).first()
        ranges = {d: (row[f"{d}__lo"], row[f"{d}__hi"]) for d in numeric}

    def within(dim: str, bound: float) -> bool:
        lo, hi = ranges.get(dim, (None, None))
        return lo is not None and -bound <= lo and hi <= bound

    def guess(dim: str) -> str | None:
        if dim in times:
            return "time"
        for name, words, bound in DIM_RULES:
            named = any(word in dim.lower() for word in words)
            if named or (bound is not None and within(dim, bound)):
                return name
        return None

    free = [n for n in STANDARD_DIMS if n not in dims]
    renames: dict[str, str] = {}
    for dim in unknown:
        name = guess(dim)
        if name in free:
            free.remove(name)
            renames[dim] = name
    return df.withColumnsRenamed(renames)


def clip_latitude(df: DataFrame, column: str = "lat") -> DataFrame:
    return df.withColumn(column, F.expr(coords.clip_latitude(column)))


def assign_levels(df: DataFrame, levels: DataFrame) -> DataFrame:
    """Attach the level labels (``lev_idx``, ``lev``) of the target axis."""
    return df.drop("lev").join(levels.select("lev_idx", "lev"), "lev_idx", "left")


def with_coordinates(df: DataFrame, cell: str = "dst_id") -> DataFrame:
    """Latitude and longitude of a cell id column."""
    return df.selectExpr(
        "*", f"{coords.cell_lat(cell)} AS lat", f"{coords.cell_lon(cell)} AS lon"
    )


def build_output(df: DataFrame, var: str, value: str) -> DataFrame:
    """Final table of one variable: coordinates, value, and the partition columns."""
    if "lat" not in df.columns:
        df = with_coordinates(df)
    level = [c for c in ("lev_idx", "lev") if c in df.columns]
    return df.select(
        "time", *level, "lat", "lon",
        F.col(value).alias("value"),
        F.lit(var).alias("var"),
        F.expr("year(time) AS year"),
        F.expr("month(time) AS month"),
    )


def canonical_order(df: DataFrame) -> DataFrame:
    """Rows of each partition in (time, level, lat, lon) order."""
    keys = [k for k in ("time", "lev_idx", "lat", "lon") if k in df.columns]
    return df.sortWithinPartitions(*keys)
