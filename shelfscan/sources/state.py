"""Load state: the cursor and current table version of each load."""

from __future__ import annotations

import dataclasses

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from shelfscan import schemas
from shelfscan.operators.filters import SCOPES, in_scope
from shelfscan.sources.dimensions import mapping_df


@dataclasses.dataclass(frozen=True)
class LoadState:
    """What the last finished load left behind.

    ``slot``: a and b in turn. ``parts``: of a table in parts, the label of each part's
    current folder. ``stream`` and ``batch``: the stream whose micro-batch was merged last,
    and that batch's number.
    """

    name: str
    version: int = 0
    cursor: int = 0
    slot: str = ""
    buckets: int = 0
    parts: tuple[str, ...] = ()
    stream: str = ""
    batch: int = -1


def read_state(spark: SparkSession, path: str, name: str) -> LoadState:
    """The state of one load, or an initial one (cursor 0) if it never ran.

    Every finished load appends a row, so a crash cannot lose the state; one row
    per load is read here.
    """
    try:
        states = spark.read.schema(schemas.LOAD_STATE).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return LoadState(name)
    row = (
        states.filter(F.col("name") == name)
        .agg(F.max(F.struct(*schemas.LOAD_STATE.names[1:])).alias("last"))
        .first()
    )
    return _state(name, row.last) if row.last else LoadState(name)


def _state(name: str, row: Row) -> LoadState:
    known = {k: v for k, v in row.asDict().items() if v is not None}  # states from before a column was added
    return LoadState(name, **{**known, "parts": tuple(row.parts or ())})


def last_states(spark: SparkSession, path: str, name: str, many: int) -> list[LoadState]:
    """The last states of a load, the newest first."""
    states = spark.read.schema(schemas.LOAD_STATE).parquet(path).filter(F.col("name") == name)
    rows = states.drop("name").orderBy(F.desc("version")).limit(many).collect()
    return [_state(name, row) for row in rows]


def append_state(spark: SparkSession, path: str, state: LoadState) -> None:
    """Makes a state the current one of its load."""
    values = {**dataclasses.asdict(state), "parts": list(state.parts)}
    row = mapping_df(spark, [tuple(values.values())], schemas.LOAD_STATE)
    row.coalesce(1).write.mode("append").parquet(path)


def high_water_marks(df: DataFrame, cursor_col: str, code: str = "code") -> DataFrame:
    """The cursor of every scope in one pass: (scope, cursor), 0 without rows."""
    scopes = [*SCOPES, "global"]
    marks = df.agg(
        *[F.max(F.when(in_scope(F.col(code), s), F.col(cursor_col))).alias(s) for s in scopes]
    )
    rows = [
        F.struct(F.lit(s).alias("scope"), F.coalesce(F.col(s), F.lit(0)).cast("bigint").alias("cursor"))
        for s in scopes
    ]
    return marks.select(F.inline(F.array(*rows)))
