"""Reading product exports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from shelfscan import schemas
from shelfscan.sources.dimensions import mapping_df


def read_products(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet export, limited to the columns that are used.

    Types are the file's own (from one footer): numbers may be stored as any
    integer, double or text; ``ingest`` casts them.
    """
    return spark.read.parquet(path).select(*schemas.SOURCE.names)


def read_modified_after(
    spark: SparkSession, path: str, moment: dt.datetime, schema: T.StructType | None = None
) -> DataFrame:
    """Only the files changed after a moment (UTC); an empty DataFrame if there are none.

    Without a schema the columns of an export are read, with their stored types.
    """
    if schema is None:
        schema = read_products(spark, path).schema
    if moment.tzinfo is not None:
        moment = moment.astimezone(dt.timezone.utc)
    stamp = moment.strftime("%Y-%m-%dT%H:%M:%S")
    reader = spark.read.schema(schema).option("modifiedAfter", stamp).option("timeZone", "UTC")
    return reader.parquet(path)


def describe_source(spark: SparkSession, path: str) -> DataFrame:
    """Columns of a Parquet file or directory with type and nullability."""
    fields = spark.read.parquet(path).schema
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in fields]
    described = T.StructType(
        [
            T.StructField("column_name", T.StringType()),
            T.StructField("column_type", T.StringType()),
            T.StructField("nullable", T.BooleanType()),
        ]
    )
    return mapping_df(spark, rows, described)


def profile_source(spark: SparkSession, path: str) -> DataFrame:
    """:func:`describe_source` with the number of values of each column, in one pass."""
    source = spark.read.parquet(path)
    counted = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("column_type"),
            F.count(F.col(f.name)).alias("n_values"),
        )
        for f in source.schema
    ]
    return source.agg(F.array(*counted).alias("columns")).select(F.inline("columns"))
