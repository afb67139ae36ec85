"""Physical plans: what must be pruned, pushed, broadcast or kept off a single task."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as registry
from shelfscan import schemas
from shelfscan.operators import with_controls
from shelfscan.plans import reports
from shelfscan.plans.mart import build_mart
from shelfscan.plans.staging import CLUSTER_BY, PARTITION_BY, build_staging
from shelfscan.plans.ingest import ingest
from shelfscan.sources import additive_families, category_groups, materialize, read_table
from shelfscan.testbed.products import products

# the text operators have tests of their own
QUERIES = {k: q for k, q in registry.queries().items() if not k.startswith("op") and k != "pipeline"}


@pytest.fixture(scope="module")
def stg(spark, sf_dir, tmp_path_factory):
    from shelfscan.sources import health_claims

    path = str(tmp_path_factory.mktemp("plans") / "stg")
    made = build_staging(ingest(products(spark, sf_dir)), health_claims(spark))
    materialize(made, path, partition_by=PARTITION_BY, cluster_by=CLUSTER_BY)
    return read_table(spark, path, schemas.STAGING)


def scanned(plan: str) -> set[str]:
    columns = re.findall(r"ReadSchema: struct<(.*?)>(?:\n|$|, )", plan)
    return {c.split(":")[0] for found in columns for c in re.split(r",(?![^<]*>)", found)}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_registered_query_plan(spark, sf_dir, plan_of, name):
    """No Python, no cross join, and no single task gathering rows.

    A shuffle to one partition may only carry partial aggregates or a limited
    number of rows.
    """
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEval", "BatchEvalPython"):
        assert word not in plan
    lines = plan.splitlines()
    for number, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert re.search(r"Aggregate|Limit", lines[number + 1])


def test_partitions_and_filters_reach_the_scan(stg, plan_of):
    plan = plan_of(reports.tile6_additive_gap(stg))
    assert re.search(r"PartitionFilters: \[.*created_year#\d+ >= 2020.*created_year#\d+ <= 2024", plan)
    assert "EqualTo(is_ultra_processed,true)" in plan
    assert scanned(plan) == {"additives_count", "is_ultra_processed", "has_health_claim"}


def test_control_window_prunes_partitions(stg, plan_of):
    import datetime as dt

    plan = plan_of(with_controls(stg, start=dt.date(2021, 3, 1), end=dt.date(2022, 1, 1)))
    assert re.search(r"PartitionFilters: \[.*created_year#\d+ >= 2021.*created_year#\d+ <= 2022", plan)
    assert "GreaterThanOrEqual(created_date,2021-03-01)" in plan


def test_scans_read_only_what_a_report_uses(stg, plan_of):
    assert scanned(plan_of(reports.tile2_claims(stg))) == {
        "has_health_claim",
        "is_ultra_processed",
        "matched_health_claims",
    }
    assert scanned(plan_of(reports.tile4_top_brands(stg))) == {"brands", "is_deceptive"}
    assert scanned(plan_of(build_mart(stg))) == {"categories_tags", "has_health_claim", "is_deceptive"}


def test_mappings_are_broadcast_by_size(spark, stg, plan_of):
    for report, mapping in (
        (reports.tile3_category_groups, category_groups),
        (reports.tile5_additives, additive_families),
    ):
        plan = plan_of(report(stg, mapping(spark)))
        assert "BroadcastHashJoin" in plan
        assert "LocalTableScan" in plan


def test_a_mapping_over_the_broadcast_limit_is_not(spark, stg, plan_of):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        plan = plan_of(reports.tile3_category_groups(stg, category_groups(spark)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan
    assert "Broadcast" not in plan


def test_top_k_is_taken_without_a_global_sort(stg, plan_of):
    plan = plan_of(reports.tile4_top_brands(stg))
    assert "TakeOrderedAndProject" in plan
    assert "rangepartitioning" not in plan


def test_brand_keys_are_computed_on_counted_spellings(stg, plan_of):
    plan = plan_of(reports.tile4_top_brands(stg))
    first_shuffle = plan.index("Exchange hashpartitioning(brands")
    assert "translate" not in plan[first_shuffle:]
    assert "partial_count" in plan[first_shuffle:]


def test_distinct_count_is_two_stage(spark, stg, plan_of):
    plan = plan_of(reports.tile3_category_groups(stg, category_groups(spark)))
    assert plan.count("HashAggregate(") == 4
    assert "partial_count(distinct product_id" in plan


def test_unused_tags_are_never_derived(spark, sf_dir, plan_of):
    plan = plan_of(QUERIES["nova_distribution"](spark, sf_dir))
    assert "lineitem" not in plan


def test_the_total_reuses_the_counted_shuffle(stg, plan_of):
    assert "ReusedExchange" in plan_of(reports.nova_distribution(stg), run=True)


def test_both_sides_of_a_merge_share_the_derivation(spark, sf_dir, plan_of):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(QUERIES["upsert_raw"](spark, sf_dir), run=True)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ReusedExchange" in plan
