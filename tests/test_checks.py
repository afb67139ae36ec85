from __future__ import annotations

import pytest

from shelfscan.operators import ChecksFailed, check_json_arrays, check_table, require
from shelfscan.plans.mart import build_mart
from shelfscan.plans.quality import run_checks
from shelfscan.plans.staging import build_staging


def report(df):
    return {(r.column, r.test): r.failures for r in df.collect()}


def checked(spark, rows):
    df = spark.createDataFrame(rows, "k string, n int, g string")
    return check_table(df, "t", not_null=["k", "n"], unique=["k"], accepted={"n": [1, 2], "g": ["a"]})


def test_passing_table(spark):
    got = checked(spark, [("x", 1, "a"), ("y", 2, None)])
    assert set(report(got).values()) == {0}
    require(got)


def test_failing_table(spark):
    rows = [("x", 1, "b"), ("x", 3, "a"), ("x", None, "b"), (None, 1, "a"), (None, 9, None)]
    assert report(checked(spark, rows)) == {
        ("k", "not_null"): 2,
        ("n", "not_null"): 1,
        ("k", "unique"): 1,
        ("n", "accepted_values"): 2,
        ("g", "accepted_values"): 2,
    }
    with pytest.raises(ChecksFailed, match="t.k unique: 1"):
        require(checked(spark, rows))


def test_empty_table_passes(spark):
    assert set(report(checked(spark, [])).values()) == {0}


def test_several_unique_columns_and_none(spark):
    df = spark.createDataFrame([("x", "p"), ("y", "p"), ("y", "q")], "a string, b string")
    got = report(check_table(df, "t", unique=["a", "b"]))
    assert got == {("a", "unique"): 1, ("b", "unique"): 1}
    assert report(check_table(df, "t", not_null=["a"])) == {("a", "not_null"): 0}


def test_only_the_key_is_shuffled_for_uniqueness(spark, plan_of):
    plan = plan_of(checked(spark, [("x", 1, "a")]))
    assert plan.count("Scan ExistingRDD") == 2
    (by_key,) = [x for x in plan.splitlines() if "keys=[k" in x and "partial_count" in x]
    assert by_key.count("count(") == 1


def test_declared_checks(raw_rows, claims):
    stg = build_staging(raw_rows({"code": "1"}, {"code": "1"}, {"code": None, "nova_group": 7}), claims)
    got = run_checks(stg, build_mart(stg, minimum=1))
    rows = {(r.model, r.column, r.test): r.failures for r in got.collect()}
    assert len(rows) == 14
    failed = {k: v for k, v in rows.items() if v}
    assert failed == {
        ("stg_products", "product_id", "not_null"): 1,
        ("stg_products", "product_id", "unique"): 1,
        ("stg_products", "nova_group", "accepted_values"): 1,
    }


def test_json_check_counts_malformed_text(spark):
    df = spark.createDataFrame([('["a"]',), ("[oops",), (None,), ("[]",)], "tags string")
    assert report(check_json_arrays(df, "raw", ["tags"])) == {("tags", "json_array"): 1}
