"""Sinks, the weights store and attributes."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridweave import schema
from gridweave.operators.coordinates import canonical_order

#: the order of the rows of a stored file
ORDER = ("time", "lev_idx", "lat", "lon")


def write_field(df: DataFrame, path: str) -> None:
    """Store a field by variable, year and month; a re-run replaces only the months it makes.

    Rows of a month are brought together, then adaptive execution splits months that are larger
    than the advisory partition size and merges those that are smaller. So a task writes few
    months, and a big month is written by many tasks. Every file is in the order of ``ORDER``, so
    its pages cover short spans of time and hour.
    """
    out = schema.conform(df if "lev" in df.columns else _without_level(df), schema.FIELD)
    (
        # never NULL and not a constant: else the writer sorts by the partition columns once more, in
        # place of the order below
        out.withColumns({"hour": F.hour("time"), "var": F.expr("concat_ws('', var, repeat('', month))")})
        .hint("rebalance", "var", "year", "month")
        .sortWithinPartitions("var", "year", "month", *ORDER)
        .write.partitionBy("var", "year", "month")
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(path)
    )


def stored_order(spark: SparkSession, path: str) -> DataFrame:
    """Rows and misplaced rows per stored variable and month: var, year, month, n, misplaced.

    A row is misplaced if it stands before a row of its file that ``ORDER`` puts first. Positions come
    from the files themselves; a window holds the rows of one file.
    """
    rows = spark.read.schema(schema.STORED_FIELD).parquet(path).selectExpr(
        "var", "year", "month", "_metadata.file_path AS _file", "_metadata.row_index AS _at",
        f"struct({', '.join(ORDER)}) AS _here",
    )
    following = rows.withColumn(
        "_next", F.lead("_here").over(Window.partitionBy("_file").orderBy("_at"))
    )
    return following.groupBy("var", "year", "month").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("_next") < F.col("_here")).alias("misplaced")
    )


def reformat(
    df: DataFrame, names: Mapping[str, str], attrs: Mapping[str, str], path: str
) -> None:
    """Store corrected fields under the variable names and attributes of the original model."""
    field = df.replace(dict(names), subset=["var"])
    write_field(field, path)
    tables = [attrs_table(df.sparkSession, var, attrs) for var in sorted(set(names.values()))]
    write_attrs(reduce(lambda a, b: a.unionByName(b), tables), f"{path}_attrs")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder all executors reach, in the folder that ``spark.checkpoint.dir`` names.

    Without that setting only a session on one machine, as in tests, gets a folder; on a cluster
    it is an error, as every executor would write to its own disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="gridweave-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _without_level(df: DataFrame) -> DataFrame:
    columns = {"lev": F.lit(None).cast("double")}
    if "lev_idx" not in df.columns:
        columns["lev_idx"] = F.lit(None).cast("int")
    return df.withColumns(columns)


def write_static(df: DataFrame, path: str) -> None:
    """Store a field without time, one file set per variable."""
    out = schema.conform(df if "lev" in df.columns else _without_level(df), schema.STATIC_FIELD)
    out = canonical_order(out)
    out.write.partitionBy("var").option("partitionOverwriteMode", "dynamic").mode(
        "overwrite"
    ).parquet(path)


def grid_fingerprint(grid: DataFrame) -> str:
    """Short text that two grids share only when they have the same cells.

    Count, xor and sum of a 64-bit hash over the cell ids: one aggregation, independent of order.
    """
    ids = grid.select("dst_id").distinct().select(F.xxhash64("dst_id").alias("h"))
    row = ids.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.bit_xor("h"), F.lit(0)).alias("x"),
        F.coalesce(F.sum(F.col("h").cast("decimal(38,0)")), F.lit(0)).alias("s"),
    ).first()
    return f"{row['n']}_{row['x'] & 0xFFFFFFFFFFFFFFFF:016x}_{int(row['s']) & 0xFFFFFFFF:08x}"


def weights_path(base: str, method: str, src_grid: str, dst_grid: str) -> str:
    return f"{base}/method={method}/src_grid={src_grid}/dst_grid={dst_grid}"


def load_or_make_weights(
    spark: SparkSession, base: str, method: str, src_grid: DataFrame,
    dst_grids: Sequence[DataFrame], make: Callable[[], DataFrame],
) -> DataFrame:
    """Weights from the store, made and stored on first use.

    The key is the method and the fingerprints of all grids the weights depend on, so weights are
    never reused for another grid. The stored table also has an exact size, which Spark uses to plan the join.
    """
    dst = "-".join(grid_fingerprint(g) for g in dst_grids)
    path = weights_path(base, method, grid_fingerprint(src_grid), dst)
    if not path_exists(spark, f"{path}/_SUCCESS"):  # a write that was committed
        schema.conform(make(), schema.WEIGHTS).write.mode("overwrite").parquet(path)
    return spark.read.schema(schema.WEIGHTS).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def output_key(
    var: str, input_name: str, target_name: str, year: Column, month: Column
) -> Column:
    """Name of a variable-month: {var}_{input}_to_{target}_{year}-{month}."""
    return F.format_string(
        f"{var}_{input_name}_to_{target_name}_%d-%02d", year.cast("int"), month.cast("int")
    )


def attach_attrs(df: DataFrame, value: str, attrs: Mapping[str, str]) -> DataFrame:
    """Attributes as metadata of the value column, added to those it has."""
    return df.withMetadata(value, {**df.schema[value].metadata, **attrs})


def attrs_table(spark: SparkSession, var: str, attrs: Mapping[str, str]) -> DataFrame:
    """Attributes of a variable as rows (var, key, value) for storing beside the field."""
    return spark.createDataFrame([(var, k, v) for k, v in attrs.items()], schema.FIELD_ATTRS)


def read_attrs(spark: SparkSession, path: str, var: str) -> dict[str, str]:
    """Stored attributes of a variable; none where the folder does not exist."""
    if not path_exists(spark, path):
        return {}
    rows = spark.read.schema(schema.FIELD_ATTRS).parquet(path).where(F.col("var") == var)
    return {r["key"]: r["value"] for r in rows.collect()}


def write_levels(levels: DataFrame, var: str, standard_name: str, path: str) -> None:
    """Kind of a variable's levels, stored beside the field, with the coefficients of sigma-pressure
    levels: ``levels`` has lev_idx, and ap and b where the kind has them."""
    lacking = {c: F.lit(None).cast("double") for c in ("ap", "b") if c not in levels.columns}
    rows = levels.withColumns({**lacking, "var": F.lit(var), "standard_name": F.lit(standard_name)})
    schema.conform(rows, schema.LEVELS).write.partitionBy("var").option(
        "partitionOverwriteMode", "dynamic"
    ).mode("overwrite").parquet(path)


def read_levels(spark: SparkSession, path: str, var: str) -> DataFrame:
    """Stored levels of a variable: standard_name, lev_idx, ap, b."""
    return spark.read.schema(schema.LEVELS).parquet(path).where(F.col("var") == var).drop("var")


def write_attrs(df: DataFrame, path: str) -> None:
    df.write.partitionBy("var").option("partitionOverwriteMode", "dynamic").mode(
        "overwrite"
    ).parquet(path)
