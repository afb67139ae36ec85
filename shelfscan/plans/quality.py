"""The declared checks of the staging table and the mart."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelfscan.operators import check_table
from shelfscan.plans.staging import GRADES


def staging_checks(stg: DataFrame) -> DataFrame:
    return check_table(
        stg,
        "stg_products",
        not_null=[
            "product_id",
            "nova_group",
            "product_name",
            "is_ultra_processed",
            "has_health_claim",
            "is_deceptive",
        ],
        unique=["product_id"],
        accepted={"nova_group": [1, 2, 3, 4], "nutriscore_grade": list(GRADES)},
    )


def mart_checks(mart: DataFrame) -> DataFrame:
    columns = ["category_tag", "products_with_claim", "deceptive_products", "deceptive_share"]
    return check_table(
        mart, "mart_deceptive_by_category", not_null=columns, unique=["category_tag"]
    )


def run_checks(stg: DataFrame, mart: DataFrame) -> DataFrame:
    """All 14 checks with their failures."""
    return staging_checks(stg).unionByName(mart_checks(mart))
