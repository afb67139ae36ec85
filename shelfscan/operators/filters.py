"""Row filters. Each is a plain predicate, so it reaches the file scan."""

from __future__ import annotations

import datetime as dt
import functools
import operator
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

#: Barcode prefixes of the default scope.
SCOPES: dict[str, tuple[str, ...]] = {"brazil": ("789", "790")}


def in_scope(code: Column, scope: str) -> Column:
    """Whether a code belongs to a scope; a scope without prefixes keeps all codes."""
    prefixes = SCOPES.get(scope.lower())
    if not prefixes:
        return F.lit(True)
    return functools.reduce(operator.or_, [code.startswith(p) for p in prefixes])


def scope_filter(df: DataFrame, scope: str, code: str = "code") -> DataFrame:
    return df.filter(in_scope(F.col(code), scope))


def since(df: DataFrame, cursor_col: str, cutoff: int, inclusive: bool = False) -> DataFrame:
    """Rows changed after the cutoff.

    ``inclusive`` takes rows with an equal stamp too: they may have arrived late,
    and the upsert that follows is idempotent.
    """
    cursor = F.col(cursor_col)
    return df.filter(cursor >= cutoff if inclusive else cursor > cutoff)


def search(df: DataFrame, patterns: Mapping[str, str], ignore_case: bool = True) -> DataFrame:
    """Rows whose columns all match their wildcard pattern."""
    for name, pattern in patterns.items():
        column = F.col(name)
        df = df.filter(column.ilike(pattern) if ignore_case else column.like(pattern))
    return df


def with_controls(
    df: DataFrame,
    grade: str | Sequence[str] | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """A viewer's choice of grades and of an inclusive window of creation dates.

    The window is also stated on ``created_year``, by which the table is partitioned.
    """
    if grade is not None:
        grades = [grade] if isinstance(grade, str) else list(grade)
        df = df.filter(F.col("nutriscore_grade").isin(*grades))
    if start is not None:
        df = df.filter((F.col("created_date") >= F.lit(start)) & (F.col("created_year") >= start.year))
    if end is not None:
        df = df.filter((F.col("created_date") <= F.lit(end)) & (F.col("created_year") <= end.year))
    return df


def cross_filter(df: DataFrame, dimension: str, value: object) -> DataFrame:
    """Restrict to one value of a dimension; for a tag column, to rows carrying the tag."""
    column = F.col(dimension)
    if isinstance(df.schema[dimension].dataType, T.ArrayType):
        return df.filter(F.array_contains(column, value))
    return df.filter(column == value)


def select_except(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All columns but the named ones."""
    return df.drop(*columns)
