"""The staging model: one typed row per product with derived flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from shelfscan import schemas
from shelfscan.functions import (
    epoch_to_date,
    epoch_to_timestamp,
    nonempty,
    normalize_grade,
    or_empty,
    ordinal_map,
    parse_json_array,
)
from shelfscan.operators import match_dictionary

#: Grades from best to worst.
GRADES = {"a": 1, "b": 2, "c": 3, "d": 4, "e": 5}

PARTITION_BY = ("created_year",)
#: The flags that reports filter by, then the day: a window of dates skips row groups.
CLUSTER_BY = ("is_deceptive", "nutriscore_grade", "is_ultra_processed", "created_date")


def _tag_array(raw: DataFrame, name: str) -> Column:
    """A tag column of the raw table as an array, whether it is one or JSON text."""
    if isinstance(raw.schema[name].dataType, T.StringType):
        text = F.col(name)
        malformed = F.raise_error(F.concat(F.lit(f"{name} is no JSON array: "), F.left(text, F.lit(100))))
        parsed = parse_json_array(text)
        return or_empty(F.when(text.isNotNull() & parsed.isNull(), malformed).otherwise(parsed))
    return or_empty(F.col(name))


def build_staging(raw: DataFrame, claims: DataFrame) -> DataFrame:
    """Staging rows of the raw table; ``claims`` is the dictionary of claim tags.

    Narrow while the dictionary is below the broadcast limit: filters and
    expressions only. A tag column that is malformed JSON text raises.
    """
    nova, grade = F.col("nova_group"), F.col("nutriscore_grade")
    named = raw.filter(nova.isNotNull() & F.col("product_name").isNotNull())
    parsed = named.withColumns({c: _tag_array(raw, c) for c in schemas.TAG_COLUMNS})
    matched = match_dictionary(parsed, "code", "labels_tags", claims, "claim_tag", "matched_health_claims")
    has_claim = nonempty(F.col("matched_health_claims"))
    return matched.select(
        F.col("code").alias("product_id"),
        "product_name",
        "nova_group",
        normalize_grade(grade, list(GRADES)).alias("nutriscore_grade"),
        ordinal_map(F.lower(grade), GRADES).alias("nutriscore_numeric"),
        "brands",
        "categories",
        *schemas.TAG_COLUMNS,
        "additives_n",
        F.size("additives_tags").alias("additives_count"),
        "ingredients_text",
        "ingredients_n",
        epoch_to_timestamp(F.col("created_t")).alias("created_at"),
        epoch_to_date(F.col("created_t")).alias("created_date"),
        F.year(epoch_to_date(F.col("created_t"))).alias("created_year"),
        "matched_health_claims",
        (nova == 4).alias("is_ultra_processed"),
        ((F.lower(grade) == "a") & (nova == 4)).alias("is_nutriscore_a_but_nova4"),
        has_claim.alias("has_health_claim"),
        (has_claim & (nova == 4)).alias("is_deceptive"),
    )
