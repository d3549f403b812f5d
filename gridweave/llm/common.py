"""Helpers the operators share: tables in the shared folder, and reading the input tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

FILES = 12  # of a narrow table, from which on it takes fewer than shuffles have partitions


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`; a new one of this machine only where that is unset and
    the session runs on one machine, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def written(df: DataFrame, name: str, narrow: bool = False) -> DataFrame:
    """The rows written to the shared folder and read again: later steps do not redo earlier ones,
    and lost executors lose nothing of them.

    Rows of a few numbers are `narrow`: an eighth of the files will do, a share that grows with the
    partitions. On local file systems every file costs the executor two processes for its rights.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    if narrow:
        df = df.coalesce(max(FILES, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Python tasks started inside get batches of so many rows at most."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def free_name(name: str, columns: list[str]) -> str:
    """A name that is none of the columns."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name
