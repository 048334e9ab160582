"""Session defaults for batch retail loads."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Everything here can be overridden by the cluster's own configuration or by the caller.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # A hot transaction or customer is split by size at run time instead of landing in one task.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # HotSpot never compiles a method above 8,000 bytes; wide cleaning projections exceed it when fused.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(app: str = "martloom", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
