from __future__ import annotations

import datetime as dt
import glob
import re

import pytest
from pyspark.sql import functions as F

from shelfscan import schemas
from shelfscan.functions.sql import register_functions
from shelfscan.operators import ChecksFailed
from shelfscan.plans.build import read_model, register_views, run_build, run_load, run_models
from shelfscan.plans.ingest import ingest, load_name, merge_into_raw, read_raw
from shelfscan.plans.staging import build_staging
from shelfscan.sources import load_seed, read_products, read_state


def test_ingest_flattens_and_filters(source_rows):
    source = source_rows(
        {"code": "7891", "product_name": [("pt", "A"), ("en", "B")], "ingredients_text": []},
        {"code": "7902", "product_name": [("pt", None)]},
        {"code": "7893", "product_name": []},
        {"code": "7894", "product_name": None},
        {"code": "7895", "nova_group": None},
        {"code": "4006"},
        {"code": "7897", "last_modified_t": 100},
    )
    raw = ingest(source, "brazil", cutoff=100)
    assert raw.schema == schemas.RAW
    got = {r.code: (r.product_name, r.ingredients_text) for r in raw.collect()}
    assert got == {"7891": ("A", None), "7902": (None, None)}
    assert {r.code for r in ingest(source, "global").collect()} == {"7891", "7902", "4006", "7897"}
    assert ingest(source, "brazil", 100, inclusive=True).count() == 3


def test_scan_is_pruned_and_filters_are_pushed(spark, source_rows, tmp_path, plan_of):
    path = str(tmp_path / "export")
    source_rows({"code": "7891"}).write.parquet(path)
    plan = plan_of(ingest(read_products(spark, path), "brazil", 5))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan, re.S).group(1)
    for part in ("StringStartsWith(code,789)", "GreaterThan(last_modified_t,5)", "IsNotNull(nova_group)"):
        assert part in pushed
    schema = plan[plan.index("ReadSchema") :]
    assert "product_name:array<struct<text:string>>" in schema
    assert "lang" not in schema
    assert "Exchange" not in plan


def content(df):
    return sorted((r.code, r.last_modified_t, r.product_name) for r in df.collect())


def export(source_rows, *rows):
    return source_rows(
        *[{"code": c, "last_modified_t": t, "product_name": [("pt", n)]} for c, t, n in rows]
    )


def test_load_upserts_and_advances_the_cursor(spark, source_rows, tmp_path):
    root, name = str(tmp_path), load_name("brazil")
    first = export(source_rows, ("7891", 10, "a"), ("7892", 20, "b"), ("7892", 15, "older"))
    state = run_load(spark, first, root)
    assert (state.version, state.cursor, state.slot) == (1, 20, "a")
    assert content(read_raw(spark, root, name)) == [("7891", 10, "a"), ("7892", 20, "b")]

    second = export(source_rows, ("7891", 30, "a2"), ("7892", 20, "same stamp"), ("7893", 25, "c"))
    state = run_load(spark, second, root)
    assert (state.version, state.cursor, state.slot) == (2, 30, "b")
    expected = [("7891", 30, "a2"), ("7892", 20, "b"), ("7893", 25, "c")]
    assert content(read_raw(spark, root, name)) == expected

    assert run_load(spark, second, root) == state
    assert content(read_raw(spark, root, name)) == expected


def test_scopes_do_not_share_state(spark, source_rows, tmp_path):
    root = str(tmp_path)
    source = export(source_rows, ("7891", 10, "a"), ("4001", 20, "b"))
    run_load(spark, source, root, "brazil")
    run_load(spark, source, root, "global")
    assert read_state(spark, f"{root}/state", load_name("brazil")).cursor == 10
    assert read_state(spark, f"{root}/state", load_name("global")).cursor == 20
    assert len(content(read_raw(spark, root, load_name("global")))) == 2
    assert content(read_raw(spark, root, load_name("brazil"))) == [("7891", 10, "a")]


def test_raw_before_any_load_is_empty(spark, tmp_path):
    raw = read_raw(spark, str(tmp_path), load_name("nowhere"))
    assert raw.schema == schemas.RAW
    assert raw.count() == 0


def test_failed_run_leaves_the_current_table(spark, source_rows, tmp_path):
    root, name = str(tmp_path), load_name("crashing")
    merge_into_raw(spark, ingest(export(source_rows, ("7891", 10, "a"))), root, name)
    broken = ingest(export(source_rows, ("7892", 20, "b"))).withColumn(
        "brands", F.raise_error(F.lit("lost")).cast("string")
    )
    try:
        merge_into_raw(spark, broken, root, name)
    except Exception as error:
        assert "lost" in str(error)
    else:
        raise AssertionError("the load should have failed")
    assert content(read_raw(spark, root, name)) == [("7891", 10, "a")]
    merge_into_raw(spark, ingest(export(source_rows, ("7892", 20, "b"))), root, name)
    assert len(content(read_raw(spark, root, name))) == 2


def test_merge_shuffles_the_delta_only(spark, source_rows, tmp_path, plan_of):
    from shelfscan.operators import upsert

    root, name = str(tmp_path), load_name("bucketed")
    many = source_rows(*[{"code": f"789{i}", "last_modified_t": i} for i in range(200)])
    merge_into_raw(spark, ingest(many), root, name, buckets=16)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = read_raw(spark, root, name)
        delta = ingest(source_rows({"code": "7895", "last_modified_t": 999}))
        plan = plan_of(upsert(base, delta, ["code"], "last_modified_t"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SelectedBucketsCount: 16 out of 16" in plan
    scan = plan.index("FileScan")
    left, right = plan[:scan], plan[scan:]
    assert "Exchange" not in left
    assert "Exchange hashpartitioning(code" in right


def forget(spark, name):
    """Drops the definitions of external tables, as a new session's catalog would lack them."""
    for row in spark.sql(f"SHOW TABLES LIKE '{name}*'").collect():
        spark.sql(f"DROP TABLE {row.tableName}")


def test_roots_do_not_mix(spark, source_rows, tmp_path):
    name = load_name("mixing")
    one, other = str(tmp_path / "one"), str(tmp_path / "other")
    merge_into_raw(spark, ingest(export(source_rows, ("7891", 10, "a"))), one, name)
    merge_into_raw(spark, ingest(export(source_rows, ("7892", 10, "b"))), other, name)
    merge_into_raw(spark, ingest(export(source_rows, ("7893", 11, "c"))), one, name)
    assert [r[0] for r in content(read_raw(spark, one, name))] == ["7891", "7893"]
    assert [r[0] for r in content(read_raw(spark, other, name))] == ["7892"]


def test_inclusive_load_takes_late_rows_with_an_equal_stamp(spark, source_rows, tmp_path):
    root = str(tmp_path)
    run_load(spark, export(source_rows, ("7891", 10, "a")), root, "late")
    late = export(source_rows, ("7891", 10, "a"), ("7892", 10, "b"))
    run_load(spark, late, root, "late")
    assert len(content(read_raw(spark, root, load_name("late")))) == 1
    run_load(spark, late, root, "late", inclusive=True)
    assert len(content(read_raw(spark, root, load_name("late")))) == 2


def test_declared_again_in_a_new_session(spark, source_rows, tmp_path):
    root, name = str(tmp_path), load_name("later")
    merge_into_raw(spark, ingest(export(source_rows, ("7891", 10, "a"))), root, name)
    forget(spark, name)
    assert content(read_raw(spark, root, name)) == [("7891", 10, "a")]
    merge_into_raw(spark, ingest(export(source_rows, ("7891", 11, "b"))), root, name)
    forget(spark, name)
    merge_into_raw(spark, ingest(export(source_rows, ("7892", 12, "c"))), root, name)
    assert content(read_raw(spark, root, name)) == [("7891", 11, "b"), ("7892", 12, "c")]


def test_buckets_can_be_changed_later(spark, source_rows, tmp_path):
    root, name = str(tmp_path), load_name("growing")

    def load(code, stamp, buckets=None):
        rows = ingest(export(source_rows, (code, stamp, "x")))
        return merge_into_raw(spark, rows, root, name, buckets=buckets).buckets

    assert [load("7891", 1), load("7892", 2, 3), load("7893", 3)] == [8, 3, 3]
    assert [r[0] for r in content(read_raw(spark, root, name))] == ["7891", "7892", "7893"]


def test_run_build_end_to_end(spark, source_rows, tmp_path):
    claims = [
        {
            "code": f"789{i}",
            "labels_tags": ["en:organic"],
            "categories_tags": ["en:yogurts"],
            "nova_group": 4 if i else 1,
            "last_modified_t": 10 + i,
        }
        for i in range(5)
    ]
    root = str(tmp_path)
    stg, mart = run_build(spark, source_rows(*claims), root)
    assert stg.schema == schemas.STAGING
    assert mart.schema == schemas.MART
    assert [tuple(r) for r in mart.collect()] == [("en:yogurts", 5, 4, 0.8)]
    later = {"code": "7890", "nova_group": 4, "labels_tags": ["en:bio"], "last_modified_t": 99}
    stg, mart = run_build(spark, source_rows(*claims, later), root)
    assert stg.count() == 5
    assert stg.filter("is_deceptive").count() == 5
    assert mart.count() == 0

    register_views(spark, root)
    register_functions(spark)
    assert spark.table("raw_products").count() == 5
    row = spark.sql(
        """
        SELECT count_if(is_deceptive) AS deceptive,
               safe_divide(count_if(is_deceptive), count(*)) AS share,
               safe_divide(1, 0) AS nothing,
               max(lower(strip_accents('Açúcar'))) AS folded,
               max(size(parse_json_array('["a", "b"]'))) AS parsed,
               max(date_of(epoch_to_timestamp(86399))) AS day
        FROM stg_products
        WHERE size(match_health_claims(labels_tags)) > 0
        """
    ).first()
    day = dt.date(1970, 1, 1)
    assert tuple(row) == (5, 1.0, None, "acucar", 2, day)


def test_names_a_catalog_would_refuse(spark, source_rows, tmp_path):
    root = str(tmp_path)
    for scope, code in (("eu-west", "7891"), ("eu_west", "7892")):
        for stamp in (1, 2):
            run_load(spark, export(source_rows, (code, stamp, "x")), root, scope)
        assert [r[0] for r in content(read_raw(spark, root, load_name(scope)))] == [code]


def test_the_delta_stands_at_equal_stamps(spark, source_rows, tmp_path):
    root, name = str(tmp_path), load_name("equal")
    merge_into_raw(spark, ingest(export(source_rows, ("7891", 5, "z"))), root, name)
    merge_into_raw(spark, ingest(export(source_rows, ("7891", 5, "a"))), root, name)
    assert content(read_raw(spark, root, name)) == [("7891", 5, "a")]


def test_buckets_grow_with_the_table(spark, source_rows, tmp_path, monkeypatch):
    root, name = str(tmp_path), load_name("larger")
    monkeypatch.setattr("shelfscan.plans.ingest.BUCKET_BYTES", 1500)
    rows = [(f"789{i:05}", 1, "x") for i in range(300)]
    first = merge_into_raw(spark, ingest(export(source_rows, *rows[:3])), root, name)
    merge_into_raw(spark, ingest(export(source_rows, *rows)), root, name)
    last = merge_into_raw(spark, ingest(export(source_rows, ("7891", 9, "y"))), root, name)
    assert last.buckets > first.buckets or first.buckets > 2
    assert len(content(read_raw(spark, root, name))) == 301


@pytest.mark.parametrize("kind", ["int", "bigint", "double", "string"])
def test_numbers_may_be_stored_as_other_types(spark, source_rows, tmp_path, kind):
    path = str(tmp_path / "export")
    rows = source_rows({"code": "7891", "nova_group": 4}).withColumn("extra", F.lit(1))
    rows.withColumn("nova_group", F.col("nova_group").cast(kind)).write.parquet(path)
    got = ingest(read_products(spark, path))
    assert got.schema == schemas.RAW
    assert [r.nova_group for r in got.collect()] == [4]


def built(spark, source_rows, root, *codes):
    rows = [{"code": c, "nova_group": 4, "labels_tags": ["en:organic"], "last_modified_t": 10} for c in codes]
    return run_build(spark, source_rows(*rows), root)


def test_a_failed_write_leaves_the_published_models(spark, source_rows, tmp_path, monkeypatch):
    root = str(tmp_path)
    built(spark, source_rows, root, "7891", "7892")

    def broken(raw, claims):
        return build_staging(raw, claims).filter(F.coalesce(F.assert_true(F.lit(False)).cast("boolean"), F.lit(True)))

    monkeypatch.setattr("shelfscan.plans.staging.build_staging", broken)
    with pytest.raises(Exception):
        run_models(spark, root)
    assert read_model(spark, root, "stg_products").count() == 2


def test_failed_checks_leave_the_published_models(spark, source_rows, tmp_path, monkeypatch):
    root = str(tmp_path)
    built(spark, source_rows, root, "7891", "7892")
    twice = lambda raw, claims: build_staging(raw, claims).union(build_staging(raw, claims))
    monkeypatch.setattr("shelfscan.plans.staging.build_staging", twice)
    with pytest.raises(ChecksFailed, match="product_id unique: 2"):
        run_models(spark, root)
    assert read_model(spark, root, "stg_products").count() == 2
    assert not glob.glob(f"{root}/models_spark_brazil/mart_deceptive_by_category/version=2")


def test_models_of_a_load_that_never_ran(spark, tmp_path):
    with pytest.raises(LookupError):
        run_models(spark, str(tmp_path), backend="stream")
    with pytest.raises(LookupError):
        read_model(spark, str(tmp_path), "stg_products")


def test_a_seed_replaces_the_packaged_claims(spark, source_rows, tmp_path):
    seed = tmp_path / "claims.csv"
    seed.write_text("# mine\nclaim_tag,claim_family\nen:bio,organic\n")
    rows = source_rows({"code": "7891", "labels_tags": ["en:bio", "en:organic"], "nova_group": 4})
    stg, _ = run_build(spark, rows, str(tmp_path / "tables"), seed=str(seed))
    assert [r.matched_health_claims for r in stg.collect()] == [["en:bio"]]
    register_functions(spark, load_seed(spark, str(seed), schemas.HEALTH_CLAIMS))
    assert spark.sql("SELECT match_health_claims(array('en:organic', 'en:bio'))").first()[0] == ["en:bio"]
    register_functions(spark)
