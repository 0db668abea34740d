"""Session defaults."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def session(name: str = "ledgerloom", **more: str) -> SparkSession:
    """A session with the library's defaults; keyword arguments use underscores for dots."""
    builder = SparkSession.builder.appName(name)
    for key, value in (DEFAULTS | {k.replace("_", "."): v for k, v in more.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
