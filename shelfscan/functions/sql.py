"""The helpers under their names in SQL, as functions of the session.

Conditional counts need no helper (``count_if``, ``FILTER``), nor does leaving
columns out (``* EXCEPT``) or unnesting (``LATERAL VIEW explode``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfscan.functions.accents import strip_accents_sql
from shelfscan.sources.dimensions import health_claims


def register_functions(spark: SparkSession, claims: DataFrame | None = None) -> None:
    """Defines the scalar helpers for SQL; they are inlined into the plan.

    ``claims``: the dictionary of ``match_health_claims``; the packaged one if left out.
    """
    (health_claims(spark) if claims is None else claims).createOrReplaceTempView("_claim_dictionary")
    dictionary = "(SELECT coalesce(collect_list(claim_tag), array()) FROM _claim_dictionary)"
    bodies = {
        "safe_divide(n DOUBLE, d DOUBLE) RETURNS DOUBLE": "try_divide(n, d)",
        "epoch_to_timestamp(seconds BIGINT) RETURNS TIMESTAMP": "timestamp_seconds(seconds)",
        "date_of(moment TIMESTAMP) RETURNS DATE": "to_date(moment)",
        "parse_json_array(text STRING) RETURNS ARRAY<STRING>": "from_json(text, 'array<string>')",
        "match_health_claims(tags ARRAY<STRING>) RETURNS ARRAY<STRING>": (
            f"array_compact(array_intersect(coalesce(tags, array()), {dictionary}))"
        ),
        "strip_accents(text STRING) RETURNS STRING": strip_accents_sql("text"),
    }
    for signature, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
