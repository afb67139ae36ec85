"""Session settings the package is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Adaptive execution coalesces small shuffle partitions, splits skewed join
#: partitions and sizes the files behind a rebalance. UTC pins every conversion
#: between instants and dates.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.parquet.filterPushdown": "true",
}


def spark_session(app_name: str = "shelfscan", master: str | None = None, **extra: str) -> SparkSession:
    """A session with :data:`SETTINGS`; ``extra`` overrides or adds settings.

    The number of shuffle partitions is left to the cluster: set it to a small
    multiple of the cores (or higher, adaptive execution merges what is too small).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
