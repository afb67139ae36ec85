"""Declarative column checks, reported as (model, column, test, failures)."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfscan.functions import parse_json_array


def _report(totals: DataFrame, model: str, counted: Sequence[tuple[str, str, str]]) -> DataFrame:
    """One wide row of failure counts turned into one row per check."""
    rows = [
        F.struct(
            F.lit(model).alias("model"),
            F.lit(column).alias("column"),
            F.lit(test).alias("test"),
            F.coalesce(F.col(failures), F.lit(0)).cast("bigint").alias("failures"),
        )
        for column, test, failures in counted
    ]
    return totals.select(F.inline(F.array(*rows)))


def _repeated(key: Column) -> Column:
    return F.count_if(key.isNotNull() & (F.col("_rows") > 1))


def check_table(
    df: DataFrame,
    model: str,
    not_null: Sequence[str] = (),
    unique: Sequence[str] = (),
    accepted: Mapping[str, Sequence[object]] | None = None,
) -> DataFrame:
    """All checks of a table: failing rows, or repeated values for ``unique``.

    Failing rows are counted per task in one pass; each ``unique`` check is a
    second one that reads and shuffles its key alone, counted before it is sent.
    NULL passes ``unique`` and ``accepted_values``.
    """
    failing = [(c, "not_null", F.col(c).isNull()) for c in not_null]
    failing += [
        (c, "accepted_values", F.col(c).isNotNull() & ~F.col(c).isin(*values))
        for c, values in (accepted or {}).items()
    ]
    reports = []
    if failing:
        sums = [F.count_if(bad).alias(f"_f{i}") for i, (_, _, bad) in enumerate(failing)]
        named = [(column, test, f"_f{i}") for i, (column, test, _) in enumerate(failing)]
        reports.append(_report(df.agg(*sums), model, named))
    for column in unique:
        counted = df.groupBy(column).agg(F.count("*").alias("_rows"))
        repeated = counted.agg(_repeated(F.col(column)).alias("_repeated"))
        reports.append(_report(repeated, model, [(column, "unique", "_repeated")]))
    return functools.reduce(DataFrame.unionByName, reports)


def check_json_arrays(df: DataFrame, model: str, columns: Sequence[str]) -> DataFrame:
    """Rows whose JSON text is there but does not parse as an array."""
    sums = [
        F.count_if(F.col(c).isNotNull() & parse_json_array(F.col(c)).isNull()).alias(f"_f{i}")
        for i, c in enumerate(columns)
    ]
    named = [(c, "json_array", f"_f{i}") for i, c in enumerate(columns)]
    return _report(df.agg(*sums), model, named)


class ChecksFailed(Exception):
    """Raised by :func:`require` with the failing checks."""


def require(report: DataFrame) -> None:
    """Runs a report (one row per declared check) and raises if any check failed."""
    failed = report.filter(F.col("failures") > 0).collect()
    if failed:
        lines = [f"{r.model}.{r.column} {r.test}: {r.failures}" for r in failed]
        raise ChecksFailed("; ".join(lines))
