"""Session settings the plans are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Recording the Python call site of every Column call is slow on long plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.parquet.compression.codec": "zstd",
}


def spark_session(app: str = "wakeline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; further settings as ``**{"spark.x": "y"}``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
