"""Writing tables: full refresh, partitioned, clustered and bucketed layouts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def materialize(
    df: DataFrame,
    path: str | None = None,
    table: str | None = None,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
) -> None:
    """Replaces a table (at ``path``, named ``table``, or both) by a DataFrame.

    Rows are brought together by partition and cluster columns with a rebalance,
    which splits groups too big for one file and merges small ones, then sorted
    so that row-group statistics let readers skip. The DataFrame must not read
    what it replaces.
    """
    if not (path or table):
        raise ValueError("materialize needs a path or a table name")
    keys = [*partition_by, *cluster_by]
    if keys:
        df = df.hint("rebalance", *keys).sortWithinPartitions(*keys)
    writer = df.write.format("parquet").mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path and table:
        writer = writer.option("path", path)
    writer.saveAsTable(table) if table else writer.save(path)


def write_raw(df: DataFrame, path: str) -> None:
    """Lands rows as Parquet at any URI Spark can write to."""
    df.write.mode("overwrite").parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A materialized Parquet table in its declared column order."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> None:
    """Replaces an external table bucketed and sorted by its keys.

    Joins on the keys then read it without a shuffle.
    """
    writer = df.write.format("parquet").mode("overwrite").option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)


def open_bucketed(
    spark: SparkSession,
    table: str,
    path: str,
    schema: T.StructType,
    keys: Sequence[str],
    buckets: int,
) -> DataFrame:
    """The bucketed table, declared again if the session's catalog does not have it.

    Refreshed first: another session may have replaced its files since.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION :path",
        args={"path": path},
    )
    spark.catalog.refreshTable(table)
    return spark.table(table)
