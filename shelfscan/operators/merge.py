"""Newest row per key, and merging a delta into a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """One row per key, the one with the largest ``order_col``.

    Equal stamps are settled by comparing the other columns in order, the same
    way every time. Each task keeps one row per key before the shuffle (the
    window's group limit), so a key holding a third of all rows is no burden.
    """
    rest = [c for c in df.columns if c not in keys and c != order_col]
    newest_first = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in (order_col, *rest)])
    ranked = df.withColumn("_rank", F.row_number().over(newest_first))
    return ranked.filter("_rank = 1").drop("_rank")


def _newest(delta: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    checked = delta.withColumns(
        {k: F.coalesce(k, F.raise_error(F.lit(f"upsert: NULL in key column {k}"))) for k in keys}
    )
    return latest_per_key(checked, keys, order_col)


def _packed(df: DataFrame, columns: Sequence[str], keys: Sequence[str], alias: str) -> DataFrame:
    """The keys and one struct of the other columns."""
    return df.select(*keys, F.struct(*[c for c in columns if c not in keys]).alias(alias))


def _older(order_col: str) -> Column:
    """Whether the base's row stays: there is no newer one, or one with an older stamp."""
    old, new = F.col(f"_old.{order_col}"), F.col(f"_new.{order_col}")
    return F.col("_new").isNull() | (F.col("_old").isNotNull() & F.coalesce(new < old, old.isNotNull()))


def upsert(base: DataFrame | None, delta: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """The base with the delta merged in: new keys added, known keys kept at their newest row.

    At equal stamps the delta's row stands: it came later. The base must hold one
    row per key (as a result of this function does); the delta may hold several.
    Applying the same delta again changes nothing, and nothing is deleted. A NULL
    key in the delta raises. If the base is bucketed by the keys it is joined in
    place and only the delta is shuffled.
    """
    newest = _newest(delta, keys, order_col)
    if base is None:
        return newest
    old, new = _packed(base, base.columns, keys, "_old"), _packed(newest, base.columns, keys, "_new")
    merged = old.join(new, list(keys), "full_outer")
    row = F.when(_older(order_col), F.col("_old")).otherwise(F.col("_new")).alias("_row")
    return merged.select(*keys, row).select(*keys, "_row.*").select(*base.columns)


def changes(base: DataFrame, delta: DataFrame, keys: Sequence[str], order_col: str, sign: str = "sign") -> DataFrame:
    """What :func:`upsert` of the same two changes: rows that go (``sign`` -1) and rows that come (1).

    A key whose row stays, or is replaced by an equal one, has neither. A sum over
    the base plus the signed rows is the sum over the merged table. Only keys of the
    delta are sent on; over a base bucketed by the keys the base's rows stay where they are.
    """
    old = _packed(base, base.columns, keys, "_old")
    new = _packed(_newest(delta, keys, order_col), base.columns, keys, "_new")
    changed = new.join(old, list(keys), "left").filter(~_older(order_col) & ~F.col("_old").eqNullSafe(F.col("_new")))
    signed = [F.struct(F.lit(s).alias(sign), F.col(c).alias("_row")) for s, c in ((-1, "_old"), (1, "_new"))]
    rows = F.explode(F.array_compact(F.array(F.when(F.col("_old").isNotNull(), signed[0]), signed[1])))
    return changed.select(*keys, rows.alias("_x")).select(*keys, f"_x.{sign}", "_x._row.*").select(sign, *base.columns)
