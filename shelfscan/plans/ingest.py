"""From the nested export to the raw product table."""

from __future__ import annotations

import hashlib
import re
import time
from collections.abc import Sequence
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T

from shelfscan import schemas
from shelfscan.functions import first_text, nonempty
from shelfscan.operators import changes, scope_filter, since, upsert
from shelfscan.sources.parts import bytes_of, open_parts, parts_of, remove_folders, touched_parts, write_parts
from shelfscan.sources.state import LoadState, append_state, last_states, read_state


#: Bytes of the raw table that a bucket is meant to hold.
BUCKET_BYTES = 1 << 30


def ingest(
    source: DataFrame, scope: str = "brazil", cutoff: int = 0, inclusive: bool = False
) -> DataFrame:
    """Classified, named products of a scope changed after the cutoff, flattened.

    The name test looks at the source list, not at the text taken from it. Tag
    columns stay arrays; ``arrays_to_json`` gives the JSON text form.
    """
    wanted = since(scope_filter(source, scope), "last_modified_t", cutoff, inclusive)
    wanted = wanted.filter(F.col("nova_group").isNotNull() & nonempty(F.col("product_name.text")))
    texts = ("product_name", "ingredients_text")
    columns = []
    for field in schemas.RAW:
        value = first_text(field.name) if field.name in texts else F.col(field.name)
        columns.append(value.cast(field.dataType).alias(field.name))
    return wanted.select(*columns)


def load_name(scope: str, backend: str = "spark") -> str:
    """Loads of different backends or scopes have different names, so cursors never mix."""
    return f"products_{backend}_{scope.lower()}"


def merge_into_raw(
    spark: SparkSession,
    delta: DataFrame,
    root: str,
    name: str,
    keys: Sequence[str] = ("code",),
    order_col: str = "last_modified_t",
    schema: T.StructType = schemas.RAW,
    buckets: int | None = None,
    log_changes: bool = False,
    batch: tuple[str, int] | None = None,
) -> LoadState:
    """Upserts a delta into the raw table of a load and advances its cursor.

    The table is kept in parts (``shelfscan.sources.parts``). The merge reads the
    parts that the delta's keys belong to, writes them anew into folders of this load
    and leaves all others alone; then the state names the current folder of every part.
    A lost executor or a failed run leaves the current folders and the cursor untouched,
    and running again gives the same rows. Without news nothing is written.

    The table is bucketed by key, so a merge shuffles the delta only. Unless told
    otherwise, the number of ``buckets`` follows the table's bytes, about
    ``BUCKET_BYTES`` each, and doubles as the table grows past that; another number
    than before rewrites the whole table in that many. The cursor is taken from the
    delta while it is written.

    ``log_changes``: also write what the merge replaces and puts in place, with a
    sign (see ``operators.changes``); ``read_changes`` gives it. The first load has
    no log.

    ``batch``: a stream's id and the number of its micro-batch. The state keeps them, so
    a batch that was merged before the stream could note it is not merged again.
    """
    state = read_state(spark, f"{root}/state", name)
    if batch and batch[0] == state.stream and batch[1] <= state.batch:
        return state
    buckets = buckets or _buckets_for(spark, delta, state, root, name)
    same = buckets == state.buckets
    touched = touched_parts(delta, keys, buckets) if state.version else []
    if not touched if state.version else delta.isEmpty():
        return state
    base = _open(spark, root, name, schema, keys, state, only=touched if same else None) if state.version else None
    version, slot = state.version + 1, "b" if state.slot == "a" else "a"
    if log_changes and base is not None:
        changes(base, delta, keys, order_col).write.mode("overwrite").parquet(_changes_path(root, name, version))
    seen = Observation()
    delta = delta.observe(seen, F.max(order_col).alias("newest"))
    merged = upsert(base, delta, keys, order_col)
    if not same:
        merged = merged.repartition(buckets, *keys)
    label = f"{slot}{version}"
    table, path = raw_table(root, name, buckets)
    write_parts(merged, table, path, schema, keys, buckets, label)
    parts = list(state.parts) if same else [label] * parts_of(buckets)
    for part in touched if same else ():
        parts[part] = label
    newest = seen.get["newest"]
    cursor = max(state.cursor, newest or 0)
    state = LoadState(name, version, cursor, slot, buckets, tuple(parts), *(batch or (state.stream, state.batch)))
    append_state(spark, f"{root}/state", state)
    return state


def _buckets_for(spark: SparkSession, delta: DataFrame, state: LoadState, root: str, name: str) -> int:
    """A power of two, by the bytes of the current table or, at first, the planned size of the delta.

    Where the planner can't tell that size, as many as the session has shuffle partitions.
    """
    if state.version:
        wanted = bytes_of(spark, raw_table(root, name, state.buckets)[1], state.parts)
    else:
        wanted = int(delta._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
        if wanted >= 1 << 60:
            return int(spark.conf.get("spark.sql.shuffle.partitions"))
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    many = 1
    while many * BUCKET_BYTES < wanted and 2 * many <= most:
        many *= 2
    return max(many, state.buckets)


def _changes_path(root: str, name: str, version: int) -> str:
    return f"{root}/{quote(name, safe='')}/changes/version={version}"


def read_changes(
    spark: SparkSession, root: str, name: str, after: int, schema: T.StructType = schemas.RAW
) -> DataFrame | None:
    """Signed rows of all loads after a version, or None where one of them has no log.

    Their sum over a column is what it grew by since that version.
    """
    state = read_state(spark, f"{root}/state", name)
    paths = [_changes_path(root, name, v) for v in range(after + 1, state.version + 1)]
    signed = T.StructType([T.StructField("sign", T.IntegerType()), *schema])
    if not paths:
        return spark.createDataFrame([], signed)
    try:
        return spark.read.schema(signed).parquet(*paths)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_raw(
    spark: SparkSession,
    root: str,
    name: str,
    keys: Sequence[str] = ("code",),
    schema: T.StructType = schemas.RAW,
) -> DataFrame:
    """The current raw table of a load."""
    state = read_state(spark, f"{root}/state", name)
    if not state.version:
        return spark.createDataFrame([], schema)
    return _open(spark, root, name, schema, keys, state)


def remove_old_raw(spark: SparkSession, root: str, name: str, keep: int = 2, days: float = 7) -> list[str]:
    """Deletes folders of parts that none of the last ``keep`` states names and that are older than ``days``.

    A reader that opened the table within those states or days loses nothing. Returns
    what was deleted.
    """
    states = last_states(spark, f"{root}/state", name, keep)
    before = int((time.time() - days * 86400) * 1000)
    removed = []
    for buckets in sorted({s.buckets for s in states}):
        kept = {(i, label) for s in states if s.buckets == buckets for i, label in enumerate(s.parts)}
        removed += remove_folders(spark, raw_table(root, name, buckets)[1], kept, before)
    return removed


def raw_table(root: str, name: str, buckets: int) -> tuple[str, str]:
    """Name and path of a load's table with so many buckets.

    The name tells roots, loads and bucket counts apart, so a definition another
    session left in the catalog is never taken for this one. Characters a catalog
    would refuse are replaced in it; the digest keeps such names apart.
    """
    path = f"{root}/{quote(name, safe='')}/buckets={buckets}"
    digest = hashlib.sha256(path.encode()).hexdigest()[:12]
    return f"{re.sub('[^A-Za-z0-9_]', '_', name)}_{buckets}_{digest}", path


def _open(spark, root, name, schema, keys, state, only=None) -> DataFrame:
    table, path = raw_table(root, name, state.buckets)
    return open_parts(spark, table, path, schema, keys, state.buckets, state.parts, only)
