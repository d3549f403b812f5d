"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings, not tuning. Partition counts belong to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a re-run replaces only the (var, year, month) partitions it produces
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # building a plan does not record the Python line of every expression
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply the settings to a session builder."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder
