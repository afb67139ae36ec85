from __future__ import annotations

import datetime as dt
import unicodedata

import pytest
from pyspark.sql import functions as F

from shelfscan import functions as fn


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


@pytest.mark.parametrize(
    "text, folded",
    [
        ("Nestlé", "nestle"),
        ("NESTLE ", "nestle"),
        (" Pão de Açúcar", "pao de acucar"),
        ("Café", "cafe"),
        ("Straße Øl Łódź œuf", "straße øl łodz œuf"),
        ("plain", "plain"),
        ("", ""),
        (None, None),
    ],
)
def test_brand_key(spark, text, folded):
    df = spark.createDataFrame([(text,)], "b string")
    assert values(df, fn.brand_key(F.col("b"))) == [folded]


def test_strip_accents_equals_decomposition_on_every_character(spark):
    """All but those that decompose to several (Hangul and some Indic letters)."""
    expected = {}
    for letter in map(chr, range(1, 0x20000)):
        decomposed = unicodedata.normalize("NFD", letter)
        kept = "".join(c for c in decomposed if unicodedata.category(c) != "Mn")
        if unicodedata.category(letter) not in ("Cs", "Cn") and len(kept) < 2:
            expected[letter] = kept

    df = spark.createDataFrame([(c,) for c in expected], "c string")
    found = df.select("c", fn.strip_accents(F.col("c")).alias("s"))
    wrong = [r for r in found.collect() if expected[r.c] != r.s]
    assert wrong == []


def test_conditional_aggregates_skip_null(spark):
    df = spark.createDataFrame([(1, True), (3, True), (5, False), (7, None)], "x int, f boolean")
    flag = F.col("f")
    row = df.agg(
        fn.countif(flag).alias("n"),
        fn.sumif(flag).alias("s"),
        fn.sum_case(flag).alias("c"),
        fn.avgif(F.col("x"), flag).alias("a"),
        fn.share_pct(flag).alias("share"),
        fn.rate_pct(flag).alias("rate"),
        fn.share_pct_raw(flag, F.col("f")).alias("raw"),
    ).first()
    assert (row.n, row.s, row.c, row.a) == (2, 2, 2, 2.0)
    assert (row.share, row.rate) == (50.0, 66.7)
    assert row.raw == pytest.approx(200 / 3)


def test_conditional_aggregates_without_rows(spark):
    df = spark.createDataFrame([], "x int, f boolean")
    flag = F.col("f")
    row = df.agg(
        fn.countif(flag), fn.sumif(flag), fn.sum_case(flag), fn.share_pct(flag), fn.rate_pct(flag)
    ).first()
    assert tuple(row) == (0, None, None, None, None)


def test_safe_divide(spark):
    df = spark.createDataFrame([(1, 4), (1, 0), (None, 2)], "n bigint, d bigint")
    assert values(df, fn.safe_divide(F.col("n"), F.col("d"))) == [0.25, None, None]


def test_percentage_ties_round_half_up(spark):
    df = spark.createDataFrame([(i < 557,) for i in range(2000)], "f boolean")
    assert df.agg(fn.share_pct(F.col("f"))).first()[0] == 27.9


def test_sorted_set(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), ("c",)], "v string")
    assert df.agg(fn.sorted_set(F.col("v"))).first()[0] == ["a", "b", "c"]


@pytest.mark.parametrize(
    "grade, normal, number",
    [("A", "a", 1), ("e", "e", 5), ("unknown", None, None), (None, None, None)],
)
def test_grades(spark, grade, normal, number):
    df = spark.createDataFrame([(grade,)], "g string")
    ranks = {"a": 1, "b": 2, "c": 3, "d": 4, "e": 5}
    row = df.select(
        fn.normalize_grade(F.col("g"), list(ranks)).alias("n"),
        fn.ordinal_map(F.lower("g"), ranks).alias("r"),
    ).first()
    assert tuple(row) == (normal, number)


def test_band(spark):
    df = spark.createDataFrame([(60.0,), (59.9,), (40.0,), (39.9,), (None,)], "x double")
    colour = fn.band(F.col("x"), [(60, "red"), (40, "orange")], "green")
    assert values(df, colour) == ["red", "orange", "orange", "green", "green"]


def test_label_and_present(spark):
    df = spark.createDataFrame([(["E1", "E2"], "Gums"), (["E3"], "")], "c array<string>, f string")
    assert values(df, fn.label(F.col("c"), F.col("f"))) == ["E1/E2 (Gums)", "E3 ()"]
    assert values(df, fn.present(F.col("f"))) == [True, False]


@pytest.mark.parametrize(
    "tag, stem",
    [
        ("en:e150d", "e150"),
        ("en:e450ii", "e450"),
        ("en:E330", "e330"),
        ("en:xyz", ""),
        ("en:e9999", "e9999"),
        ("fr:e330", ""),
    ],
)
def test_code_stem(spark, tag, stem):
    df = spark.createDataFrame([(tag,)], "t string")
    assert values(df, fn.code_stem(F.col("t"))) == [stem]


def test_drop_language_removes_every_occurrence(spark):
    df = spark.createDataFrame([("en:x",), ("pt:en:x",), ("pt:x",)], "t string")
    assert values(df, fn.drop_language(F.col("t"))) == ["x", "pt:x", "pt:x"]


def test_intersect(spark):
    rows = [(None,), ([],), (["x", "x", "z"],), (["z", None, "x", "q"],)]
    df = spark.createDataFrame(rows, "t array<string>")
    dictionary = F.array(F.lit("x"), F.lit("z"), F.lit(None))
    assert values(df, fn.intersect(F.col("t"), dictionary)) == [[], [], ["x", "z"], ["z", "x"]]


def test_first_text(spark):
    schema = "t array<struct<lang:string,text:string>>"
    df = spark.createDataFrame([([("pt", "a"), ("en", "b")],), ([],), (None,)], schema)
    assert values(df, fn.first_text("t")) == ["a", None, None]


def test_json_codec(spark):
    rows = [(["a", 'q"', "é"],), ([],), (None,), (["a", None],)]
    df = spark.createDataFrame(rows, "t array<string>")
    text = fn.json_array(F.col("t"))
    assert values(df, text) == ['["a","q\\"","é"]', "[]", "[]", '["a",null]']
    assert values(df, fn.parse_json_array(text)) == [["a", 'q"', "é"], [], [], ["a", None]]


def test_malformed_json_is_null(spark):
    df = spark.createDataFrame([('["a", "b"]',), ("[oops",), ("",), (None,)], "j string")
    assert values(df, fn.parse_json_array(F.col("j"))) == [["a", "b"], None, None, None]


@pytest.mark.parametrize(
    "seconds, day",
    [
        (1577836799, dt.date(2019, 12, 31)),
        (1577836800, dt.date(2020, 1, 1)),
        (-1, dt.date(1969, 12, 31)),
        (0, dt.date(1970, 1, 1)),
    ],
)
def test_epoch_to_date_ignores_the_session_zone(spark, seconds, day):
    df = spark.createDataFrame([(seconds,)], "s bigint")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("UTC", "America/Sao_Paulo", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", other)
            assert values(df, fn.epoch_to_date(F.col("s"))) == [day]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_epoch_to_timestamp_and_date_of(spark):
    df = spark.createDataFrame([(1577836799,)], "s bigint")
    moment = fn.epoch_to_timestamp(F.col("s"))
    assert values(df, moment.cast("string")) == ["2019-12-31 23:59:59"]
    assert values(df, fn.date_of(moment)) == [dt.date(2019, 12, 31)]


def test_distinct_count(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "v string")
    assert df.agg(fn.distinct_count("v")).first()[0] == 2
