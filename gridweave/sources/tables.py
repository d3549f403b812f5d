"""Fields made from the relational test tables.

Every row of a table goes into the field: keys are mapped onto coordinates, and values are
averaged where several rows share a point. Irrational-looking factors keep values away from
rounding ties.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the test fields
VALUE_FACTOR = 0.00031415926535
TARGET_FACTOR = 0.000031415926535
HEIGHT_FACTOR = 0.00031415926535
RISE_FACTOR = 0.98765432101
SERIES_FACTOR = 0.031415926535
# level, ap, b of a five-level sigma-pressure axis
SIGMA_LEVELS = [(1, 0.0, 0.99), (2, 1500.0, 0.83), (3, 6200.0, 0.51), (4, 9800.0, 0.17), (5, 4100.0, 0.0)]
# level, a, b of a five-level hybrid-height axis
HYBRID_LEVELS = [(1, 20.0, 0.99), (2, 300.0, 0.91), (3, 1900.0, 0.62), (4, 7400.0, 0.13), (5, 21000.0, 0.0)]


# Declared columns of the tables used, so that no file is opened to learn them
COLUMNS = {
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz""",
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz",
    "events": "ts timestamp_ntz, user_id bigint, event_type string, value double",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _month_and_hour(date: str) -> str:
    """First of the month, at 00, 06, 12 or 18 hours by the month."""
    month = f"CAST(trunc({date}, 'MM') AS TIMESTAMP_NTZ)"
    return f"{month} + make_dt_interval(0, CAST(6 * (month({date}) % 4) AS INT)) AS time"


_SOURCE_TIME = _month_and_hour("l_shipdate")
_SOURCE_CELL = ("-90D + 45 * (l_suppkey % 5) AS lat", "90D * (l_partkey % 4) AS lon")
_TARGET_TIME = _month_and_hour("o_orderdate")
_TARGET_LEVEL = "CAST(1 + (o_orderkey div 24) % 5 AS INT) AS lev_idx"
_TARGET_CELL = ("-75D + 30 * (o_custkey % 6) AS lat", "30D * ((o_orderkey div 2) % 12) AS lon")


def _mean_at(df: DataFrame, keys: tuple[str, ...], **values: str) -> DataFrame:
    """Means of columns at the points given by key expressions."""
    points = df.selectExpr(*keys, *values.values())
    names = [k.rsplit(" AS ", 1)[1] for k in keys]
    return points.groupBy(*names).agg(*[F.expr(f"avg({c}) AS {n}") for n, c in values.items()])


def source_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-dimensional source: value, geopotential, humidity on 7 levels, 5 x 4 cells."""
    means = _mean_at(
        table(spark, sf_dir, "lineitem"),
        (_SOURCE_TIME, "l_linenumber AS lev_idx", *_SOURCE_CELL),
        price="l_extendedprice", quantity="l_quantity",
    )
    return means.selectExpr(
        "time", "lev_idx", "lat", "lon", f"price * {VALUE_FACTOR}D AS value",
        f"9.80665D * (500D * lev_idx * lev_idx + quantity * {RISE_FACTOR}D) AS geopotential",
        f"quantity * {VALUE_FACTOR}D AS humidity",
    )


def staggered_geopotential(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Geopotential on cells of its own, 6 x 4 and off the source's."""
    means = _mean_at(
        table(spark, sf_dir, "lineitem"),
        (
            _SOURCE_TIME, "l_linenumber AS lev_idx", "-87.5D + 35 * (l_suppkey % 6) AS lat",
            "10.25D + 90 * (l_partkey % 4) AS lon",
        ),
        quantity="l_quantity",
    )
    return means.selectExpr(
        "time", "lev_idx", "lat", "lon",
        f"9.80665D * (500D * lev_idx * lev_idx + quantity * {RISE_FACTOR}D) AS geopotential",
    )


def source_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells (lat, lon) of the source field, one row per row of the table."""
    return table(spark, sf_dir, "lineitem").selectExpr(*_SOURCE_CELL)


def target_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells (lat, lon) of the target field, one row per row of the table."""
    return table(spark, sf_dir, "orders").selectExpr(*_TARGET_CELL)


def target_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target model: a value on 5 levels, 6 x 12 cells."""
    keys = (_TARGET_TIME, _TARGET_LEVEL, *_TARGET_CELL)
    means = _mean_at(table(spark, sf_dir, "orders"), keys, price="o_totalprice")
    return means.selectExpr("time", "lev_idx", "lat", "lon", f"price * {TARGET_FACTOR}D AS value")


def target_surface_pressure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surface pressure (time, lat, lon, ps) of the target model."""
    means = _mean_at(
        table(spark, sf_dir, "orders"), (_TARGET_TIME, *_TARGET_CELL), price="o_totalprice"
    )
    return means.selectExpr("time", "lat", "lon", f"95000D + price * {HEIGHT_FACTOR}D AS ps")


def static_heights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heights (lev_idx, lat, lon, zfull) of the target levels, from about 100 m to 37 km."""
    means = _mean_at(
        table(spark, sf_dir, "orders"), (_TARGET_LEVEL, *_TARGET_CELL), price="o_totalprice"
    )
    rise = "60D * lev_idx * lev_idx * lev_idx * lev_idx"
    return means.selectExpr("lev_idx", "lat", "lon", f"{rise} + price * {HEIGHT_FACTOR}D AS zfull")


def wind_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells (lat, lon) of a staggered grid, half a cell off the target's."""
    return table(spark, sf_dir, "orders").selectExpr(
        "-60D + 30 * (o_custkey % 5) AS lat", "15D + 30 * ((o_orderkey div 2) % 11) AS lon"
    )


def surface_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surface field of the source cells: all levels of the source table averaged."""
    means = _mean_at(
        table(spark, sf_dir, "lineitem"), (_SOURCE_TIME, *_SOURCE_CELL), price="l_extendedprice"
    )
    return means.selectExpr("time", "lat", "lon", f"price * {VALUE_FACTOR}D AS value")


def events_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time series: variable, cell and value of every event."""
    return table(spark, sf_dir, "events").selectExpr(
        "ts AS time", "event_type AS var", "user_id AS cell", f"value * {SERIES_FACTOR}D AS value"
    )


def station_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of seven cells, dense enough for time statistics."""
    return table(spark, sf_dir, "events").selectExpr(
        "ts AS time", "event_type AS var", "user_id % 7 AS cell",
        f"value * {SERIES_FACTOR}D AS value",
    )


def embedding_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One 64-level column per vector: height rising with the level, value from the vector."""
    vectors = table(spark, sf_dir, "embeddings")
    rows = vectors.selectExpr("vec_id", "label", "posexplode(embedding) AS (lev_idx, e)")
    return rows.selectExpr(
        "vec_id", "label", "lev_idx", "100D * lev_idx + 40D * CAST(e AS DOUBLE) AS z",
        "CAST(e AS DOUBLE) * 314.15926535D AS value",
    )


def embedding_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eleven target heights per vector: below, inside and above its profile."""
    vectors = table(spark, sf_dir, "embeddings")
    rows = vectors.selectExpr("vec_id", "label", "explode(sequence(0, 10)) AS lev_idx")
    return rows.selectExpr("vec_id", "lev_idx", "-150D + 670D * lev_idx + 3.7D * label AS x")


def sigma_levels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SIGMA_LEVELS, "lev_idx int, ap double, b double")


def hybrid_levels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(HYBRID_LEVELS, "lev_idx int, a double, b double")
