"""Aggregating operators that stay distributed for any number of groups."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def share_of_total(df: DataFrame, by: str, count: str = "products", pct: str = "pct") -> DataFrame:
    """Rows per value and their percentage of all rows, to one decimal.

    The total is a scalar subquery over the counted rows, which reuses their
    shuffle; an unpartitioned window would move every group into one task.
    """
    counted = df.groupBy(by).agg(F.count("*").alias(count))
    total = counted.agg(F.sum(count)).scalar()
    return counted.withColumn(pct, F.round(F.try_divide(F.col(count) * 100.0, total), 1))


def group_mode(
    df: DataFrame,
    value: str,
    key: Callable[[Column], Column],
    key_alias: str,
    mode_alias: str,
    count_alias: str,
) -> DataFrame:
    """Rows per computed key with the most frequent value, the smallest one on ties.

    Counts the values first, so the key is computed once per distinct value
    instead of once per row, a hot key reaches the second shuffle as few rows,
    and no task holds all values of a key.
    """
    counted = df.groupBy(value).agg(F.count("*").alias("_n"))
    return (
        counted.groupBy(key(F.col(value)).alias(key_alias))
        .agg(
            F.min(F.struct((-F.col("_n")).alias("rank"), F.col(value).alias("value"))).alias("_top"),
            F.sum("_n").alias(count_alias),
        )
        .select(key_alias, F.col("_top.value").alias(mode_alias), count_alias)
    )


def min_support(df: DataFrame, count: str, minimum: int) -> DataFrame:
    """Groups with at least the given number of rows (``HAVING``)."""
    return df.filter(F.col(count) >= minimum)


def top_k(df: DataFrame, by: str, k: int, ties: Sequence[str]) -> DataFrame:
    """The k rows with the largest value; ties are cut by the given columns, ascending."""
    return df.orderBy(F.col(by).desc(), *ties).limit(k)


def daily_counts(df: DataFrame, day: Column) -> DataFrame:
    """Rows per date in date order."""
    return df.groupBy(day.alias("day")).agg(F.count("*").alias("n")).orderBy("day")
