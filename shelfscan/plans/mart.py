"""The category mart: how many products with a claim are ultra-processed, per category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfscan.functions import countif, safe_divide
from shelfscan.operators import explode_tags, min_support

CLUSTER_BY = ("category_tag",)

#: Categories with fewer products carrying a claim are not in the mart.
MINIMUM = 5


def category_counts(stg: DataFrame) -> DataFrame:
    """Products carrying a claim, and deceptive ones, of every category tag.

    What the mart is made from. Unlike shares, the counts of two sets of products
    add up, so they can be kept up to date from changes.
    """
    claiming = stg.filter("has_health_claim")
    return (
        explode_tags(claiming, "categories_tags", "category_tag", keep=["is_deceptive"])
        .groupBy("category_tag")
        .agg(
            F.count("*").alias("products_with_claim"),
            countif(F.col("is_deceptive")).alias("deceptive_products"),
        )
    )


def changed_counts(counts: DataFrame, gone: DataFrame, come: DataFrame) -> DataFrame:
    """Counts of the products after some staging rows went and some came; categories left empty go.

    Work grows with the changed products and the categories, not with the catalogue.
    """

    def signed(part: DataFrame, sign: int) -> DataFrame:
        return part.select("category_tag", *[(F.col(c) * sign).alias(c) for c in part.columns if c != "category_tag"])

    parts = counts.unionByName(signed(category_counts(gone), -1)).unionByName(signed(category_counts(come), 1))
    sums = {c: F.sum(c).alias(c) for c in ("products_with_claim", "deceptive_products")}
    return parts.groupBy("category_tag").agg(*sums.values()).filter("products_with_claim > 0")


def mart_of(counts: DataFrame, minimum: int = MINIMUM) -> DataFrame:
    """The mart's rows of counted categories."""
    share: Column = safe_divide(F.col("deceptive_products"), F.col("products_with_claim"))
    return min_support(counts.withColumn("deceptive_share", share), "products_with_claim", minimum)


def build_mart(stg: DataFrame, minimum: int = MINIMUM) -> DataFrame:
    """One row per category tag with at least ``minimum`` products carrying a claim."""
    return mart_of(category_counts(stg), minimum)
