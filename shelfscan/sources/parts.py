"""Keyed tables in parts: a load replaces the files of the parts it touches and no others.

The table is bucketed by its key; neighbouring buckets make a part, and a part's files
lie in a folder named after the load that wrote them (``part=7/load=b12``). Which
load's folder is a part's current one is known by whoever keeps the table's state, as
a list of labels by part. A reader names its labels, so folders of later or failed
loads don't disturb it; a load writes its own folders only.

All parts together are still one bucketed table: a join on the key reads it in
place, whichever loads its parts come from.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

#: Parts of a table at most; more buckets share parts.
PARTS = 4096

PART, LOAD = "part", "load"


def parts_of(buckets: int) -> int:
    """How many parts a table of so many buckets has."""
    return -(-buckets // _each(buckets))


def _each(buckets: int) -> int:
    """Buckets of a part."""
    return -(-buckets // PARTS)


def part_of(keys: Sequence[str], buckets: int) -> Column:
    """The part that a key belongs to: its bucket, as the writer of buckets numbers them, by the buckets of a part."""
    bucket = F.pmod(F.hash(*keys), F.lit(buckets))
    return F.floor(bucket / _each(buckets)).cast("int")


def touched_parts(delta: DataFrame, keys: Sequence[str], buckets: int) -> list[int]:
    """Parts that rows of a delta belong to; reads the keys alone, and brings a number per part to the driver."""
    return sorted(r[0] for r in delta.select(part_of(keys, buckets)).distinct().collect())


def declare_parts(
    spark: SparkSession, table: str, path: str, schema: T.StructType, keys: Sequence[str], buckets: int
) -> None:
    """Makes the table known to the session's catalog if it is not."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {PART} INT, {LOAD} STRING) USING parquet "
        f"PARTITIONED BY ({PART}, {LOAD}) CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION :path",
        args={"path": path},
    )


def open_parts(
    spark: SparkSession,
    table: str,
    path: str,
    schema: T.StructType,
    keys: Sequence[str],
    buckets: int,
    labels: Sequence[str],
    only: Collection[int] | None = None,
) -> DataFrame:
    """The rows of the parts' current folders; of some parts, if told ``only`` which.

    ``labels``: by part, the load whose folder is current; empty where a part has no rows.
    Other folders are neither listed nor read.
    """
    declare_parts(spark, table, path, schema, keys, buckets)
    current = [label if only is None or i in only else "" for i, label in enumerate(labels)]
    known = [f"PARTITION ({PART} = {i}, {LOAD} = '{label}')" for i, label in enumerate(current) if label]
    if known:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(known)}")
    spark.catalog.refreshTable(table)
    listed = ", ".join(f"'{label}'" for label in current) or "''"
    chosen = F.expr(f"get(array({listed}), {PART}) = {LOAD}")
    return spark.table(table).filter(chosen).select(*schema.names)


def write_parts(
    df: DataFrame, table: str, path: str, schema: T.StructType, keys: Sequence[str], buckets: int, label: str
) -> None:
    """Writes the rows of whole parts as a load's folders; what a failed try of the same load left there is replaced."""
    spark = df.sparkSession
    declare_parts(spark, table, path, schema, keys, buckets)
    system, tried = _files(spark, part_folder(path, "*", label))
    for found in system.globStatus(tried) or ():
        system.delete(found.getPath(), True)
    rows = df.select(*schema.names, part_of(keys, buckets).alias(PART), F.lit(label).alias(LOAD))
    rows.write.insertInto(table)


def part_folder(path: str, part: int | str, label: str) -> str:
    return f"{path}/{PART}={part}/{LOAD}={label}"


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Deletes a folder; whether it was there."""
    system, folder = _files(spark, path)
    return bool(system.delete(folder, True))


def bytes_of(spark: SparkSession, path: str, labels: Sequence[str]) -> int:
    """Bytes of the parts' current folders."""
    total = 0
    for part, label in enumerate(labels):
        if label:
            system, folder = _files(spark, part_folder(path, part, label))
            total += system.getContentSummary(folder).getLength() if system.exists(folder) else 0
    return total


def remove_folders(spark: SparkSession, path: str, kept: Collection[tuple[int, str]], before: int) -> list[str]:
    """Deletes folders of parts that are not ``kept`` (part, label) and not changed since a moment (ms); returns them."""
    system, pattern = _files(spark, f"{path}/{PART}=*/{LOAD}=*")
    removed = []
    for found in system.globStatus(pattern) or ():
        folder = found.getPath()
        name = folder.toString()
        part, label = int(folder.getParent().getName().partition("=")[2]), folder.getName().partition("=")[2]
        if (part, label) not in kept and found.getModificationTime() < before:
            system.delete(folder, True)
            removed.append(name)
    return removed
