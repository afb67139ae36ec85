"""The incremental load as a stream of arriving export files.

Each micro-batch goes through the same flattening and the same upsert as the
batch load. The stream's checkpoint remembers which files were taken, so the
cursor is not used to select rows. The load's state keeps the stream's id and the
number of the last merged batch: a batch that is replayed writes nothing.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from shelfscan import schemas
from shelfscan.plans.ingest import ingest, load_name, merge_into_raw
from shelfscan.sources import read_products


def checkpoint_folder(spark: SparkSession, name: str) -> str:
    """A folder for one stream under the shared checkpoint folder the cluster names."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError("set spark.checkpoint.dir or pass a checkpoint folder")
    return f"{shared.rstrip('/')}/{name}"


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream that a checkpoint folder belongs to; a new folder is a new stream, its batches count anew."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def _stored(spark: SparkSession, source_dir: str) -> T.StructType:
    """The used columns with the types the files have; the declared ones while there are no files."""
    try:
        return read_products(spark, source_dir).schema
    except AnalysisException as error:
        if error.getCondition() not in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
            raise
        return schemas.SOURCE


def stream_into_raw(
    spark: SparkSession,
    source_dir: str,
    root: str,
    scope: str = "brazil",
    buckets: int | None = None,
    checkpoint: str | None = None,
    max_files_per_batch: int = 1000,
) -> StreamingQuery:
    """Merges the export files not taken yet, then stops by itself.

    The models of this load are built with ``backend="stream"``.
    """
    name = load_name(scope, backend="stream")
    checkpoint = checkpoint or checkpoint_folder(spark, name)

    def merge(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        delta = ingest(batch, scope, cutoff=0)
        merge_into_raw(session, delta, root, name, buckets=buckets, batch=(stream_id(session, checkpoint), batch_id))

    arriving = (
        spark.readStream.schema(_stored(spark, source_dir))
        .option("maxFilesPerTrigger", max_files_per_batch)
        .parquet(source_dir)
    )
    return (
        arriving.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def newest_per_key(stream: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """The newest row of each key of a stream, for a sink in update mode.

    A micro-batch emits the keys it has rows of, with their newest row so far; the
    state store keeps one row per key, so nothing older is read again. Same rows, and the
    same choice between equal stamps, as ``operators.latest_per_key``. Rows are compared
    in the tasks that read them first, so a hot key sends one row per task.
    """
    rest = [c for c in stream.columns if c not in keys and c != order_col]
    newest = stream.groupBy(*keys).agg(F.max(F.struct(order_col, *rest)).alias("_row"))
    return newest.select(*keys, "_row.*").select(*stream.columns)
