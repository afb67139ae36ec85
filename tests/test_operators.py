from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfscan import operators as op
from shelfscan.sources import mapping_df
from shelfscan.schemas import CATEGORY_GROUPS


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_scope_filter(spark):
    df = spark.createDataFrame([("7891",), ("7902",), ("4003",), (None,)], "code string")
    assert rows(op.scope_filter(df, "brazil")) == [("7891",), ("7902",)]
    assert rows(op.scope_filter(df, "BRAZIL")) == [("7891",), ("7902",)]
    assert len(rows(op.scope_filter(df, "global"))) == 4


def test_since(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "t bigint")
    assert rows(op.since(df, "t", 2)) == [(3,)]
    assert rows(op.since(df, "t", 2, inclusive=True)) == [(2,), (3,)]


def test_search(spark):
    df = spark.createDataFrame(
        [("Leite Integral", "LATICÍNIOS"), ("leite semi", "Laticínios"), (None, "Laticínios")],
        "n string, c string",
    )
    assert len(rows(op.search(df, {"n": "LEITE%integral%", "c": "%laticínios%"}))) == 1
    assert rows(op.search(df, {"c": "%LAT%"}, ignore_case=False)) == [("Leite Integral", "LATICÍNIOS")]


def controls_table(spark):
    return spark.createDataFrame(
        [
            ("a", dt.date(2020, 1, 1), 2020, ["x", "y"]),
            ("b", dt.date(2021, 6, 1), 2021, ["y"]),
            (None, dt.date(2022, 1, 1), 2022, []),
        ],
        "nutriscore_grade string, created_date date, created_year int, tags array<string>",
    )


def test_with_controls(spark):
    df = controls_table(spark)
    assert op.with_controls(df).count() == 3
    assert op.with_controls(df, grade="a").count() == 1
    assert op.with_controls(df, grade=["a", "b"]).count() == 2
    window = op.with_controls(df, start=dt.date(2020, 1, 1), end=dt.date(2021, 6, 1))
    assert window.count() == 2
    assert op.with_controls(df, start=dt.date(2020, 1, 2)).count() == 2


def test_cross_filter(spark):
    df = controls_table(spark)
    assert op.cross_filter(df, "tags", "y").count() == 2
    assert op.cross_filter(df, "nutriscore_grade", "b").count() == 1


def test_select_except(spark):
    assert op.select_except(controls_table(spark), ["tags", "created_year"]).columns == [
        "nutriscore_grade",
        "created_date",
    ]


def test_explode_drops_null_and_empty(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "k int, t array<string>")
    assert rows(op.explode_tags(df, "t", "tag", keep=["k"])) == [(1, "a"), (1, "b")]


def test_tag_join_is_inner(spark):
    df = spark.createDataFrame([("yogurts",), ("nothing",), (None,)], "category string")
    groups = mapping_df(spark, [("yogurts", "Fermented Dairy")], CATEGORY_GROUPS)
    assert rows(op.tag_join(df, groups, "category", "tag")) == [("yogurts", "Fermented Dairy")]


MATCH_ROWS = [(1, ["x", "q"]), (2, ["x", "x", "z"]), (3, []), (4, None), (5, [None, "z"])]


MATCHERS = [op.match_dictionary, op.match_joined]


@pytest.mark.parametrize("match", MATCHERS)
def test_match_keeps_the_order_of_the_row(spark, match):
    df = spark.createDataFrame([*MATCH_ROWS, (6, ["z", "x", "z"])], "id int, t array<string>")
    dim = spark.createDataFrame([("x",), ("z",), ("x",)], "tag string")
    got = match(df, "id", "t", dim, "tag", "m").orderBy("id")
    assert [r.m for r in got.collect()] == [["x"], ["x", "z"], [], [], ["z"], ["z", "x"]]
    assert got.columns == ["id", "t", "m"]


@pytest.mark.parametrize("match", MATCHERS)
def test_match_with_empty_dictionary(spark, match):
    df = spark.createDataFrame(MATCH_ROWS, "id int, t array<string>")
    dim = spark.createDataFrame([], "tag string")
    assert [r.m for r in match(df, "id", "t", dim, "tag", "m").collect()] == [[]] * 5


def test_a_dictionary_of_any_size_matches_the_same(spark, plan_of, monkeypatch):
    df = spark.createDataFrame([(1, ["4999", "7", "x"]), (2, ["5000"]), (3, None)], "id int, t array<string>")
    dim = spark.range(5000).select(F.col("id").cast("string").alias("tag"))
    small = op.match_dictionary(df, "id", "t", dim, "tag", "m").orderBy("id").collect()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1KB")
    try:
        large = op.match_dictionary(df, "id", "t", dim, "tag", "m").orderBy("id")
        assert "Join" in plan_of(large)
        assert large.collect() == small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [r.m for r in small] == [["4999", "7"], [], []]


def test_share_of_total(spark):
    df = spark.createDataFrame([(1,), (1,), (4,), (None,)], "g int")
    got = op.share_of_total(df, "g").orderBy("g")
    assert rows(got) == [(None, 1, 25.0), (1, 2, 50.0), (4, 1, 25.0)]


def test_share_of_total_without_rows(spark):
    assert rows(op.share_of_total(spark.createDataFrame([], "g int"), "g")) == []


def test_group_mode(spark):
    brands = ["Nestlé", "nestle", "NESTLE ", "nestle", "Zé", "Ze"]
    df = spark.createDataFrame([(b,) for b in brands], "brands string")
    from shelfscan.functions import brand_key

    got = op.group_mode(df, "brands", brand_key, "k", "brand", "n").orderBy("k")
    assert rows(got) == [("nestle", "nestle", 4), ("ze", "Ze", 2)]


def test_top_k_cuts_ties_by_key(spark):
    df = spark.createDataFrame([("c", 2), ("a", 1), ("b", 2), ("d", 2)], "k string, n int")
    assert rows(op.top_k(df, "n", 2, ties=["k"])) == [("b", 2), ("c", 2)]


def test_min_support(spark):
    df = spark.createDataFrame([("a", 4), ("b", 5)], "k string, n int")
    assert rows(op.min_support(df, "n", 5)) == [("b", 5)]


def test_daily_counts(spark):
    df = spark.createDataFrame([(0,), (86399,), (86400,)], "t bigint")
    from shelfscan.functions import epoch_to_date

    got = op.daily_counts(df, epoch_to_date(F.col("t")))
    assert rows(got) == [(dt.date(1970, 1, 1), 2), (dt.date(1970, 1, 2), 1)]


def test_arrays_to_json(spark):
    df = spark.createDataFrame([(1, ["a"]), (2, None)], "k int, t array<string>")
    assert rows(op.arrays_to_json(df, ["t"])) == [(1, '["a"]'), (2, "[]")]
