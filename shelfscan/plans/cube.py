"""Viewer controls over all flag tiles from one stored aggregate.

A viewer picks a grade, a window of years and a category in one tile, and all others
follow. Instead of reading staging for each choice, products are counted once by
every combination of grade, year and flags, for all products and for each category
tag. A choice then reads a few thousand counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfscan.functions import drop_language
from shelfscan.plans.staging import GRADES

#: What a viewer may choose from besides the tag.
_CHOICES = ("nutriscore_grade", "created_year")
_FLAGS = ("nova_group", "is_ultra_processed", "has_health_claim", "is_deceptive")


def build_cube(stg: DataFrame) -> DataFrame:
    """(tag, nutriscore_grade, created_year, flags.., level, products, additives): sums of products.

    One pass: every product counts once for all products (tag NULL) and once for each
    of its distinct category tags. Grouping sets leave out the grade, the year or both,
    so a choice that doesn't restrict one of them reads fewer rows; ``level`` tells them apart
    (2: no grade, 1: no year, 3: neither).
    """
    all_and_tags = F.concat(F.array(F.lit(None).cast("string")), F.array_distinct(F.array_compact("categories_tags")))
    counted = stg.select(F.explode(all_and_tags).alias("tag"), *_CHOICES, *_FLAGS, "additives_count")
    tag, kept = F.col("tag"), [F.col(c) for c in _FLAGS]
    grade, year = (F.col(c) for c in _CHOICES)
    sets = [[tag, *kept, grade, year], [tag, *kept, grade], [tag, *kept, year], [tag, *kept]]
    level = (F.grouping("nutriscore_grade").cast("int") * 2 + F.grouping("created_year").cast("int")).alias("level")
    sums = F.count("*").alias("products"), F.sum("additives_count").alias("additives")
    return counted.groupingSets(sets, tag, *kept, grade, year).agg(level, *sums)


def choose(
    cube: DataFrame,
    tag: str | None = None,
    grade: str | None = None,
    years: tuple[int, int] | None = None,
    by: str | None = None,
) -> DataFrame:
    """The rows of a cube that a choice leaves, at the coarsest level that has the columns asked for.

    ``years``: first and last. ``by``: one of grade and year that the reader groups by.
    """
    needs_grade = grade is not None or by == "nutriscore_grade"
    needs_year = years is not None or by == "created_year"
    rows = cube.filter(F.col("level") == (0 if needs_grade else 2) + (0 if needs_year else 1))
    rows = rows.filter(F.col("tag").isNull() if tag is None else F.col("tag") == tag)
    if grade is not None:
        rows = rows.filter(F.col("nutriscore_grade") == grade)
    if years is not None:
        rows = rows.filter(F.col("created_year").between(*years))
    return rows


def _sum_if(condition: str, value: str = "products") -> Column:
    return F.coalesce(F.sum(F.when(F.expr(condition), F.col(value))), F.lit(0))


def cube_kpis(cube: DataFrame, **choice) -> DataFrame:
    """``reports.kpis`` of a choice."""
    counts = choose(cube, **choice).agg(
        F.coalesce(F.sum("products"), F.lit(0)).alias("total"),
        _sum_if("is_ultra_processed").alias("nova4"),
        _sum_if("has_health_claim").alias("with_claim"),
        _sum_if("is_deceptive").alias("deceptive"),
    )
    share = F.round(F.try_divide(100.0 * F.col("deceptive"), F.col("with_claim")), 1)
    return counts.withColumn("pct_deceptive", F.coalesce(share, F.lit(0.0)))


def cube_tile1(cube: DataFrame, **choice) -> DataFrame:
    """``reports.tile1_paradox`` of a choice."""
    rows = choose(cube, by="nutriscore_grade", **choice).filter(F.col("nutriscore_grade").isin(*GRADES))
    counted = rows.groupBy("nutriscore_grade").agg(
        F.sum("products").alias("total"), _sum_if("is_ultra_processed").alias("nova4")
    )
    share = F.round(100.0 * F.col("nova4") / F.col("total"), 1)
    return counted.withColumn("pct_nova4", share).orderBy("nutriscore_grade")


def cube_tile6(cube: DataFrame, years: tuple[int, int] = (2020, 2024), **choice) -> DataFrame:
    """``reports.tile6_additive_gap`` of a choice."""
    rows = choose(cube, years=years, by="created_year", **choice).filter("is_ultra_processed")
    claim, other = "has_health_claim", "NOT has_health_claim"
    sums = rows.groupBy("created_year").agg(
        _sum_if(claim).alias("deceptive_n"),
        _sum_if(other).alias("non_deceptive_n"),
        _sum_if(claim, "additives").alias("_with"),
        _sum_if(other, "additives").alias("_without"),
    )
    return sums.select(
        "created_year",
        F.try_divide("_with", "deceptive_n").alias("avg_deceptive"),
        F.try_divide("_without", "non_deceptive_n").alias("avg_non_deceptive"),
        "deceptive_n",
        "non_deceptive_n",
    ).orderBy("created_year")


def cube_nova(cube: DataFrame, **choice) -> DataFrame:
    """``reports.nova_distribution`` of a choice, without shares."""
    return choose(cube, **choice).groupBy("nova_group").agg(F.sum("products").alias("products")).orderBy("nova_group")


def cross_filtered_tiles(cube: DataFrame, **choice) -> DataFrame:
    """Three tiles of one choice in long form: (tile, item, measure, value)."""

    def long(tile: str, rows: DataFrame, item: Column, *measures: str) -> DataFrame:
        each = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures])
        return rows.select(F.lit(tile).alias("tile"), item.cast("string").alias("item"), F.inline(each))

    years = choice.pop("years", None)
    kpis = long(
        "kpis", cube_kpis(cube, years=years, **choice), F.lit("all"), "total", "nova4", "with_claim", "deceptive", "pct_deceptive"
    )
    grades = long("tile1", cube_tile1(cube, years=years, **choice), F.col("nutriscore_grade"), "total", "nova4", "pct_nova4")
    window = {"years": years} if years else {}
    gap = long(
        "tile6", cube_tile6(cube, **window, **choice), F.col("created_year"),
        "avg_deceptive", "avg_non_deceptive", "deceptive_n", "non_deceptive_n",
    )
    return kpis.unionByName(grades).unionByName(gap)


def tag_choices(cube: DataFrame, k: int = 100) -> DataFrame:
    """The tags a viewer may choose, the commonest first."""
    tags = cube.filter("level = 3 AND tag IS NOT NULL").groupBy("tag").agg(F.sum("products").alias("products"))
    return tags.orderBy(F.desc("products"), "tag").limit(k).select(drop_language(F.col("tag")).alias("label"), "tag", "products")
