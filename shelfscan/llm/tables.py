"""Intermediate results in the folder that all executors share."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names; on one machine, where it may be unset, one in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir')}/_intermediate"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df``, computed and written to the shared checkpoint folder."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, so that its size is known to the planner."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def batches_of(spark: SparkSession, rows: int, size: int = 16 << 20) -> Iterator[None]:
    """Rows, and bytes, handed to Python at once by what runs inside, at most: rows that carry whole sets are large."""
    least = {"spark.sql.execution.arrow.maxRecordsPerBatch": rows, "spark.sql.execution.arrow.maxBytesPerBatch": size}
    before = {key: spark.conf.get(key, None) for key in least}
    for key, most in least.items():
        known = before[key] or ""
        spark.conf.set(key, str(min(most, int(known)) if known.isdigit() and int(known) > 0 else most))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
