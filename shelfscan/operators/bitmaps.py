"""Exact distinct counts that add up: bitmaps over dense numbers.

A count of distinct keys can't be summed over days or shops. A bitmap of the keys'
numbers can be merged: kept per group and year, it answers any range of years with
an OR and a count of bits, without the rows it came from.

Numbers are dense, so a bitmap has few empty stretches: a piece covers 32,768
numbers in 4 KB, and a group has a piece only where one of its keys has a number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def dense_numbers(df: DataFrame, key: str, known: DataFrame | None = None, deals: int = 1024) -> DataFrame:
    """(key, number): the distinct non-NULL keys, numbered from 0 without gaps.

    Keys are dealt by hash into ``deals`` parts and numbered within each; a part's
    numbers begin where those of the parts before end, which are ``deals`` counts to
    add up, whatever the number of keys. ``known``: numbers given before, which stay;
    new keys go on from there.
    """
    keys = df.select(key).filter(F.col(key).isNotNull()).distinct()
    first = F.lit(0).cast("bigint")
    if known is not None:
        keys = keys.join(known.select(key), key, "left_anti")
        first = known.agg(F.coalesce(F.max("number") + 1, F.lit(0))).scalar()
    dealt = keys.withColumn("_deal", F.pmod(F.xxhash64(key), F.lit(deals)))
    counted = dealt.groupBy("_deal").agg(F.count("*").alias("_n"))
    # at most ``deals`` rows are added up in one task
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_deal").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begins = counted.select("_deal", before.alias("_begin"))
    place = F.row_number().over(Window.partitionBy("_deal").orderBy(key)) - 1
    numbered = dealt.withColumn("_place", place).join(begins, "_deal")
    numbered = numbered.select(key, (F.col("_begin") + F.col("_place") + first).alias("number"))
    return numbered if known is None else known.select(key, "number").unionByName(numbered)


def distinct_bitmaps(df: DataFrame, by: Sequence[str], number: str = "number") -> DataFrame:
    """(by.., piece, bitmap): which numbers each group has."""
    position = F.bitmap_bit_position(number)
    pieces = df.select(*by, F.bitmap_bucket_number(number).alias("piece"), position.alias("_position"))
    return pieces.groupBy(*by, "piece").agg(F.bitmap_construct_agg("_position").alias("bitmap"))


def merge_bitmaps(bitmaps: DataFrame, by: Sequence[str]) -> DataFrame:
    """The bitmaps of coarser groups."""
    return bitmaps.groupBy(*by, "piece").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def count_distinct_bitmaps(bitmaps: DataFrame, by: Sequence[str], alias: str) -> DataFrame:
    """Distinct numbers of each group, in whichever of its bitmaps they are."""
    merged = merge_bitmaps(bitmaps, by)
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count("bitmap")).alias(alias))
