"""Small dimension tables: packaged values, inline relations and seed files."""

from __future__ import annotations

import csv
from collections.abc import Iterable
from importlib import resources

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shelfscan import schemas


def mapping_df(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType) -> DataFrame:
    """An inline relation.

    Handed over as an Arrow table, so it becomes a local relation whose size
    Spark knows: a join broadcasts it because it was measured, not by a hint.
    """
    columns = list(zip(*rows)) or [[] for _ in schema]
    arrow = to_arrow_schema(schema)
    table = pa.table([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)
    return spark.createDataFrame(table, schema)


def load_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A seed CSV with a header and declared types; lines starting with ``#`` are comments."""
    return spark.read.schema(schema).option("header", True).option("comment", "#").csv(path)


def packaged_rows(name: str) -> list[dict[str, str]]:
    """Rows of a CSV of the package, read on the driver: executors may not have the file."""
    text = resources.files("shelfscan.data").joinpath(f"{name}.csv").read_text("utf-8")
    return list(csv.DictReader(line for line in text.splitlines() if not line.startswith("#")))


def _packaged(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    integers = {f.name for f in schema if isinstance(f.dataType, T.IntegerType)}
    rows = [
        tuple(int(r[f]) if f in integers else r[f] for f in schema.names)
        for r in packaged_rows(name)
    ]
    return mapping_df(spark, rows, schema)


def health_claims(spark: SparkSession) -> DataFrame:
    """Claim tags and their families."""
    return _packaged(spark, "health_claims", schemas.HEALTH_CLAIMS)


def category_groups(spark: SparkSession) -> DataFrame:
    """Category tags and the group they are reported under."""
    return _packaged(spark, "category_groups", schemas.CATEGORY_GROUPS)


def additive_families(spark: SparkSession) -> DataFrame:
    """E-number stems and their families."""
    return _packaged(spark, "additive_families", schemas.ADDITIVE_FAMILIES)


def additive_refs(spark: SparkSession) -> DataFrame:
    """Health references of additive families in display order."""
    return _packaged(spark, "additive_refs", schemas.ADDITIVE_REFS)
