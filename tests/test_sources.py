from __future__ import annotations

import datetime as dt
import os
from importlib import resources

import pytest
from pyspark.sql import functions as F

from shelfscan import schemas
from shelfscan import sources as src


def test_packaged_dimensions(spark):
    assert src.health_claims(spark).count() == 14
    groups = src.category_groups(spark)
    assert (groups.count(), groups.select("grp").distinct().count()) == (91, 15)
    assert groups.select("tag").distinct().count() == 91
    families = src.additive_families(spark)
    assert (families.count(), families.select("code").distinct().count()) == (127, 127)
    assert families.select("category").distinct().count() == 31
    refs = src.additive_refs(spark).orderBy("ord").collect()
    assert [r.category for r in refs] == ["Phosphates", "Polyols", "Sweeteners", "Sorbates"]
    assert refs[1].concern.endswith("disease, and gut-microbiota disruption.")


def test_seed_file_equals_the_packaged_relation(spark):
    path = str(resources.files("shelfscan.data").joinpath("health_claims.csv"))
    seed = src.load_seed(spark, path, schemas.HEALTH_CLAIMS)
    assert sorted(seed.collect()) == sorted(src.health_claims(spark).collect())


def test_mapping_df_types_and_empty(spark):
    schema = schemas.ADDITIVE_REFS
    one = src.mapping_df(spark, [(1, "c", None, "u'\"")], schema)
    assert one.schema == schema
    assert [tuple(r) for r in one.collect()] == [(1, "c", None, "u'\"")]
    assert src.mapping_df(spark, [], schema).count() == 0


def test_read_products_reads_declared_columns_only(spark, source_rows, tmp_path, plan_of):
    path = str(tmp_path / "export")
    source_rows({"code": "1"}).withColumn("extra", F.lit(1)).write.parquet(path)
    df = src.read_products(spark, path)
    assert df.schema == schemas.SOURCE
    assert "extra" not in plan_of(df)


def test_read_modified_after(spark, source_rows, tmp_path):
    path = tmp_path / "export"
    source_rows({"code": "1"}).coalesce(1).write.parquet(str(path))
    (file,) = [f for f in os.listdir(path) if f.endswith(".parquet")]
    changed = dt.datetime(2024, 5, 1, 12, 0, tzinfo=dt.timezone.utc)
    os.utime(path / file, (changed.timestamp(), changed.timestamp()))
    before = src.read_modified_after(spark, str(path), changed - dt.timedelta(minutes=1))
    after = src.read_modified_after(spark, str(path), changed + dt.timedelta(minutes=1))
    assert (before.count(), after.count()) == (1, 0)
    assert after.schema == schemas.SOURCE


def test_describe_source(spark, sf_dir):
    got = {r.column_name: r.column_type for r in src.describe_source(spark, f"{sf_dir}/orders.parquet").collect()}
    assert got["o_orderkey"] == "bigint"
    assert got["o_orderstatus"] == "string"
    assert len(got) == 6


def test_materialize_partitions_and_sorts(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(1000).select(
        (2020 + F.col("id") % 3).cast("int").alias("year"), (F.col("id") % 2 == 0).alias("flag"), "id"
    )
    src.materialize(df, path, partition_by=["year"], cluster_by=["flag"])
    src.materialize(df.filter("id < 500"), path, partition_by=["year"], cluster_by=["flag"])
    assert sorted(n for n in os.listdir(path) if "=" in n) == ["year=2020", "year=2021", "year=2022"]
    back = spark.read.parquet(path)
    assert back.count() == 500
    file = back.select(F.input_file_name()).first()[0]
    flags = [r.flag for r in spark.read.parquet(file).collect()]
    assert flags == sorted(flags)


def test_materialize_as_named_table(spark):
    df = spark.range(3)
    src.materialize(df, table="materialized_numbers")
    src.materialize(df.filter("id > 0"), table="materialized_numbers")
    assert spark.table("materialized_numbers").count() == 2
    with pytest.raises(ValueError):
        src.materialize(df)


def test_write_raw(spark, raw_rows, tmp_path):
    path = str(tmp_path / "landed")
    src.write_raw(raw_rows({"code": "1"}), path)
    assert src.read_table(spark, path, schemas.RAW).count() == 1


def test_state_is_kept_per_load(spark, tmp_path):
    path = str(tmp_path / "state")
    assert src.read_state(spark, path, "one") == src.LoadState("one")
    src.append_state(spark, path, src.LoadState("one", 1, 10, "a", 4))
    src.append_state(spark, path, src.LoadState("other", 1, 99, "a", 4))
    src.append_state(spark, path, src.LoadState("one", 2, 20, "b", 4))
    assert src.read_state(spark, path, "one") == src.LoadState("one", 2, 20, "b", 4)
    assert src.read_state(spark, path, "other").cursor == 99
    assert src.read_state(spark, path, "third") == src.LoadState("third")


def test_high_water_marks(spark, raw_rows):
    raw = raw_rows(
        {"code": "7891", "last_modified_t": 5}, {"code": "4001", "last_modified_t": 9}
    )
    got = {r.scope: r.cursor for r in src.high_water_marks(raw, "last_modified_t").collect()}
    assert got == {"brazil": 5, "global": 9}
    none = src.high_water_marks(raw.limit(0), "last_modified_t")
    assert {r.cursor for r in none.collect()} == {0}
