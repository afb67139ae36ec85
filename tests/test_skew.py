"""One key with a third of all rows or more: results stay whole, work is split."""

from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F

from shelfscan.operators import group_mode, match_joined, tag_join
from shelfscan.sources import materialize

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture
def small_limits(spark):
    """Limits at which test data counts as large."""
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot_tags(spark, rows=200_000):
    """A third of the rows on one tag, the rest on a thousand."""
    tag = F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("t"), F.pmod(F.xxhash64("id"), F.lit(1000)))
    )
    return spark.range(0, rows, 1, 8).select("id", tag.alias("category"), F.uuid().alias("payload"))


def test_join_with_a_mapping_splits_a_hot_tag(spark, plan_of, small_limits):
    mapping = spark.range(1000).select(
        F.concat(F.lit("t"), F.col("id")).alias("tag"), (F.col("id") % 7).cast("string").alias("grp")
    )
    mapping = mapping.union(spark.createDataFrame([("hot", "hot group")], "tag string, grp string"))
    joined = tag_join(hot_tags(spark), mapping, "category", "tag").select("grp", "payload")
    assert "skew=true" in plan_of(joined, run=True)
    counts = joined.groupBy("grp").count().collect()
    assert sum(r["count"] for r in counts) == 200_000
    assert {r.grp: r["count"] for r in counts}["hot group"] == 66_667


def test_matching_a_large_dictionary_keeps_every_row(spark, small_limits):
    rows = hot_tags(spark, 30_000).select("id", F.array("category", F.lit("never")).alias("tags"))
    dictionary = spark.createDataFrame([("hot",), ("t1",), ("t2",)], "tag string")
    matched = match_joined(rows, "id", "tags", dictionary, "tag", "m")
    assert matched.count() == 30_000
    assert matched.filter(F.array_contains("m", "hot")).count() == 10_000


def test_a_hot_brand_is_counted_whole(spark):
    spelled = F.when(F.col("id") % 3 == 0, "Café").when(F.col("id") % 3 == 1, "CAFE").otherwise(
        F.concat(F.lit("b"), F.col("id") % 50)
    )
    df = spark.range(90_000).select(spelled.alias("brand"))
    got = group_mode(df, "brand", lambda b: F.lower(F.translate(b, "é", "e")), "k", "m", "n")
    (hot,) = got.filter("k = 'cafe'").collect()
    assert (hot.m, hot.n) == ("CAFE", 60_000)


def test_a_hot_layout_group_is_written_as_several_files(spark, tmp_path, small_limits):
    path = str(tmp_path / "t")
    df = spark.range(0, 100_000, 1, 8).select(
        F.lit(2024).alias("year"), (F.col("id") % 1000 == 0).alias("flag"), F.uuid().alias("payload")
    )
    materialize(df, path, partition_by=["year"], cluster_by=["flag"])
    assert len(glob.glob(f"{path}/year=2024/*.parquet")) > 4
    assert spark.read.parquet(path).count() == 100_000
