"""The named reports over the staging table. Each returns a small, ordered DataFrame."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from shelfscan.functions import (
    avgif,
    brand_key,
    code_stem,
    countif,
    distinct_count,
    drop_language,
    label,
    present,
    rate_pct,
    share_pct,
    share_pct_raw,
    sorted_set,
    sum_case,
    sumif,
)
from shelfscan.operators import (
    count_distinct_bitmaps,
    distinct_bitmaps,
    explode_tags,
    gram_search,
    group_mode,
    min_support,
    search,
    share_of_total,
    tag_join,
    top_k,
)
from shelfscan.plans.staging import GRADES


def kpis(stg: DataFrame) -> DataFrame:
    """Counts of all, ultra-processed, claiming and deceptive products, and the deceptive share."""
    counts = stg.agg(
        F.count("*").alias("total"),
        countif(F.col("is_ultra_processed")).alias("nova4"),
        countif(F.col("has_health_claim")).alias("with_claim"),
        countif(F.col("is_deceptive")).alias("deceptive"),
    )
    share = F.round(F.try_divide(100.0 * F.col("deceptive"), F.col("with_claim")), 1)
    return counts.withColumn("pct_deceptive", F.coalesce(share, F.lit(0.0)))


def kpis_by_case(stg: DataFrame) -> DataFrame:
    """The three flag counts as sums of 0/1, NULL on an empty table."""
    return stg.agg(
        sum_case(F.col("is_ultra_processed")).alias("nova4_count"),
        sum_case(F.col("has_health_claim")).alias("claim_count"),
        sum_case(F.col("is_deceptive")).alias("deceptive_count"),
    )


def tile1_paradox(stg: DataFrame) -> DataFrame:
    """Ultra-processed products per grade."""
    return (
        stg.filter(F.col("nutriscore_grade").isin(*GRADES))
        .groupBy("nutriscore_grade")
        .agg(
            F.count("*").alias("total"),
            countif(F.col("is_ultra_processed")).alias("nova4"),
            share_pct(F.col("is_ultra_processed")).alias("pct_nova4"),
        )
        .orderBy("nutriscore_grade")
    )


def tile1_raw_pct(stg: DataFrame) -> DataFrame:
    """Unrounded ultra-processed percentage per grade."""
    return (
        stg.filter(F.col("nutriscore_grade").isNotNull())
        .groupBy("nutriscore_grade")
        .agg(share_pct_raw(F.col("is_ultra_processed"), F.col("product_id")).alias("pct_nova4"))
        .orderBy("nutriscore_grade")
    )


def tile2_claims(stg: DataFrame) -> DataFrame:
    """Ultra-processed share per health claim."""
    return (
        explode_tags(
            stg.filter("has_health_claim"), "matched_health_claims", "claim", keep=["is_ultra_processed"]
        )
        .groupBy("claim")
        .agg(
            F.count("*").alias("total"),
            countif(F.col("is_ultra_processed")).alias("nova4"),
            share_pct(F.col("is_ultra_processed")).alias("pct_nova4"),
        )
        .select(drop_language(F.col("claim")).alias("label"), "total", "nova4", "pct_nova4")
        .orderBy(F.desc("pct_nova4"), "label")
    )


def tile3_category_groups(stg: DataFrame, groups: DataFrame) -> DataFrame:
    """Distinct deceptive products per category group.

    A product counts once per group, however many of its tags fall in it.
    """
    tagged = explode_tags(stg.filter("is_deceptive"), "categories_tags", "tag", keep=["product_id"])
    categories = tagged.select("product_id", drop_language(F.col("tag")).alias("category"))
    return (
        tag_join(categories, groups, "category", "tag")
        .groupBy(F.col("grp").alias("category_group"))
        .agg(distinct_count("product_id").alias("products"))
        .orderBy(F.desc("products"), "category_group")
    )


def tile3_bitmaps(stg: DataFrame, groups: DataFrame, numbers: DataFrame) -> DataFrame:
    """Deceptive products of each category group and year as bitmaps; ``numbers``: of the products.

    To be kept: :func:`tile3_from_bitmaps` answers any range of years from it.
    """
    deceptive = stg.filter("is_deceptive").join(numbers, "product_id")
    tagged = explode_tags(deceptive, "categories_tags", "tag", keep=["number", "created_year"])
    categories = tagged.select("number", "created_year", drop_language(F.col("tag")).alias("category"))
    grouped = tag_join(categories, groups, "category", "tag").withColumnRenamed("grp", "category_group")
    return distinct_bitmaps(grouped, ["category_group", "created_year"])


def tile3_from_bitmaps(bitmaps: DataFrame, first: int, last: int) -> DataFrame:
    """:func:`tile3_category_groups` of products created from one year to another."""
    chosen = bitmaps.filter(F.col("created_year").between(first, last))
    return count_distinct_bitmaps(chosen, ["category_group"], "products").orderBy(F.desc("products"), "category_group")


def tile4_top_brands(stg: DataFrame, k: int = 10) -> DataFrame:
    """Brands with most deceptive products, spellings folded, shown in the commonest one."""
    branded = stg.filter(F.col("is_deceptive") & present(F.col("brands")))
    folded = group_mode(branded, "brands", brand_key, "_key", "brand", "products")
    return top_k(folded, "products", k, ties=["_key"]).select("brand", "products")


def tile4_any_brand(stg: DataFrame, k: int = 10) -> DataFrame:
    """:func:`tile4_top_brands` shown in any spelling; the smallest, to be repeatable."""
    branded = stg.filter(F.col("is_deceptive") & present(F.col("brands")))
    spellings = branded.groupBy("brands").agg(F.count("*").alias("_n"))
    folded = spellings.groupBy(brand_key(F.col("brands")).alias("_key")).agg(
        F.min("brands").alias("brand"), F.sum("_n").alias("products")
    )
    return top_k(folded, "products", k, ties=["_key"]).select("brand", "products")


def tile5_additives(stg: DataFrame, families: DataFrame, k: int = 5) -> DataFrame:
    """Additive families most used in deceptive products, with their codes and a label.

    Tags are counted before codes are cut out of them and joined, so both work
    on distinct tags.
    """
    tags = explode_tags(stg.filter("is_deceptive"), "additives_tags", "tag")
    counted = tags.groupBy("tag").agg(F.count("*").alias("n"))
    coded = counted.select(code_stem(F.col("tag")).alias("base_code"), "n")
    ranked = (
        tag_join(coded, families, "base_code", "code")
        .groupBy("category")
        .agg(
            F.sum("n").alias("occurrences"),
            sorted_set(F.upper("base_code")).alias("codes"),
        )
    )
    top = top_k(ranked, "occurrences", k, ties=["category"])
    return top.withColumn("label", label(F.col("codes"), F.col("category")))


def tile5_codes_string(stg: DataFrame, families: DataFrame, k: int = 5) -> DataFrame:
    """:func:`tile5_additives` with the codes as one string."""
    top = tile5_additives(stg, families, k)
    return top.select("category", "occurrences", F.array_join("codes", "/").alias("codes"))


def tile5_references(stg: DataFrame, families: DataFrame, refs: DataFrame, k: int = 5) -> DataFrame:
    """Health references of the top families, in the order of the references."""
    top = tile5_additives(stg, families, k).select("category")
    shown = refs.join(top, "category", "left_semi")
    return shown.orderBy("ord").select("category", "concern", "url")


def tile6_additive_gap(stg: DataFrame, first: int = 2020, last: int = 2024) -> DataFrame:
    """Average additives of ultra-processed products per year, with and without a claim."""
    claim, count = F.col("has_health_claim"), F.col("additives_count")
    return (
        stg.filter(F.col("is_ultra_processed") & F.col("created_year").between(first, last))
        .groupBy("created_year")
        .agg(
            avgif(count, claim).alias("avg_deceptive"),
            avgif(count, ~claim).alias("avg_non_deceptive"),
            countif(claim).alias("deceptive_n"),
            countif(~claim).alias("non_deceptive_n"),
        )
        .orderBy("created_year")
    )


def total_products(stg: DataFrame) -> DataFrame:
    return stg.agg(F.count("*").alias("total_products"))


def nova_distribution(stg: DataFrame) -> DataFrame:
    """Products per processing group and their share of all."""
    return share_of_total(stg, "nova_group").orderBy("nova_group")


def claims_by_nova(stg: DataFrame) -> DataFrame:
    """Claiming products per processing group."""
    return (
        stg.filter("has_health_claim")
        .groupBy("nova_group")
        .agg(
            F.count("*").alias("with_claim"),
            rate_pct(F.col("is_ultra_processed")).alias("pct_nova4"),
        )
        .orderBy("nova_group")
    )


def paradox_products(stg: DataFrame, k: int = 20) -> DataFrame:
    """Best-graded ultra-processed products with most additives."""
    paradox = stg.filter("is_nutriscore_a_but_nova4").select(
        "product_id",
        "product_name",
        "brands",
        "nutriscore_grade",
        "nova_group",
        "additives_count",
        "matched_health_claims",
    )
    return top_k(paradox, "additives_count", k, ties=["product_id"])


def deceptive_brands(stg: DataFrame, minimum: int = 5, k: int = 20) -> DataFrame:
    """Brands, as spelled, with the highest deceptive share."""
    rated = (
        stg.filter(F.col("brands").isNotNull())
        .groupBy("brands")
        .agg(
            F.count("*").alias("total"),
            sumif(F.col("is_deceptive")).alias("deceptive"),
            rate_pct(F.col("is_deceptive")).alias("deceptive_pct"),
        )
    )
    return top_k(min_support(rated, "total", minimum), "deceptive_pct", k, ties=["brands"])


def claims_on_nova4(stg: DataFrame) -> DataFrame:
    """How often each claim is on an ultra-processed product."""
    claiming = stg.filter(F.col("is_ultra_processed") & F.col("has_health_claim"))
    return (
        explode_tags(claiming, "matched_health_claims", "claim")
        .groupBy("claim")
        .agg(F.count("*").alias("occurrences"))
        .orderBy(F.desc("occurrences"), "claim")
    )


def product_search(
    stg: DataFrame, name: str, category: str, k: int = 100, postings: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Products by name and category wildcard, whatever the case, most processed first.

    ``postings``: trigram postings of the columns, where they are kept.
    """
    found = gram_search(stg, "product_id", {"product_name": name, "categories": category}, postings or {})
    top = top_k(found, "nova_group", k, ties=["product_id"])
    return top.select("product_name", "brands", "ingredients_text", "nova_group")


def source_search(source: DataFrame, category: str, brand: str, k: int = 10) -> DataFrame:
    """Whole rows of the export by category and brand wildcard, the first by code."""
    found = search(source, {"categories": category, "brands": brand}, ignore_case=False)
    return found.orderBy("code").limit(k)
