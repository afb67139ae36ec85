"""Bitmaps and the cube: what is read from stored aggregates equals what the rows give."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shelfscan import operators as op
from shelfscan.plans import cube as cubes
from shelfscan.plans import reports
from shelfscan.plans.ingest import ingest
from shelfscan.plans.staging import build_staging
from shelfscan.sources import category_groups, health_claims
from shelfscan.testbed.products import products


@pytest.fixture(scope="module")
def stg(spark, sf_dir):
    folder = sf_dir.replace("sf0.01", "sf0.001")
    return build_staging(ingest(products(spark, folder)), health_claims(spark)).persist()


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_numbers_are_dense_and_stay(spark):
    keys = spark.createDataFrame([(f"k{i % 500}",) for i in range(1500)] + [(None,)], "k string")
    first = op.dense_numbers(keys, "k", deals=7).persist()
    assert sorted(r.number for r in first.collect()) == list(range(500))
    more = op.dense_numbers(spark.createDataFrame([(f"k{i}",) for i in range(400, 800)], "k string"), "k", first, deals=3)
    found = {r.k: r.number for r in more.collect()}
    assert sorted(found.values()) == list(range(800))
    assert {r.k: r.number for r in first.collect()}.items() <= found.items()


def test_numbers_of_nothing(spark):
    empty = spark.createDataFrame([], "k string")
    assert op.dense_numbers(empty, "k").count() == 0
    assert rows(op.dense_numbers(spark.createDataFrame([("a",)], "k string"), "k", op.dense_numbers(empty, "k"))) == [("a", 0)]


def test_numbering_gathers_counts_only(spark, plan_of):
    """The one window without a partition stands over the counted deals, not over the keys."""
    plan = plan_of(op.dense_numbers(spark.range(10).select(F.col("id").alias("k")), "k"))
    single = plan[plan.index("Exchange SinglePartition") :]
    assert "HashAggregate" in single.splitlines()[1]


def test_bitmaps_count_what_distinct_counts(spark):
    rng = random.Random(1)
    data = [(rng.choice("abc"), rng.randint(2018, 2024), rng.randrange(100_000)) for _ in range(5000)]
    df = spark.createDataFrame(data, "g string, y int, number bigint")
    stored = op.distinct_bitmaps(df, ["g", "y"])
    for first, last in ((2018, 2024), (2020, 2021), (2030, 2031)):
        chosen = df.filter(F.col("y").between(first, last))
        expected = sorted(rows(chosen.groupBy("g").agg(F.count_distinct("number"))))
        kept = stored.filter(F.col("y").between(first, last))
        assert sorted(rows(op.count_distinct_bitmaps(kept, ["g"], "n"))) == expected
    # bitmaps of two halves merge into those of the whole
    halves = [op.distinct_bitmaps(df.filter(F.col("number") % 2 == i), ["g", "y"]) for i in (0, 1)]
    assert sorted(rows(op.merge_bitmaps(halves[0].union(halves[1]), ["g", "y"]))) == sorted(rows(stored))


def test_tile3_of_any_years(spark, stg):
    groups = category_groups(spark)
    numbers = op.dense_numbers(stg.select("product_id"), "product_id")
    stored = reports.tile3_bitmaps(stg, groups, numbers).persist()
    for first, last in ((1900, 2100), (2018, 2019), (2021, 2021)):
        chosen = stg.filter(F.col("created_year").between(first, last))
        assert rows(reports.tile3_from_bitmaps(stored, first, last)) == rows(reports.tile3_category_groups(chosen, groups))


CHOICES = [
    {},
    {"grade": "e"},
    {"years": (2019, 2021)},
    {"tag": "en:yogurts"},
    {"tag": "en:yogurts", "grade": "b", "years": (2020, 2024)},
    {"tag": "en:nowhere"},
]


@pytest.fixture(scope="module")
def cube(stg):
    return cubes.build_cube(stg).persist()


@pytest.mark.parametrize("choice", CHOICES)
def test_a_choice_gives_what_the_filtered_rows_give(stg, cube, choice):
    first, last = choice.get("years", (1900, 2100))
    chosen = op.with_controls(stg, choice.get("grade"), dt.date(first, 1, 1), dt.date(last, 12, 31))
    if "tag" in choice:
        chosen = op.cross_filter(chosen, "categories_tags", choice["tag"])
    assert rows(cubes.cube_kpis(cube, **choice)) == rows(reports.kpis(chosen))
    assert rows(cubes.cube_tile1(cube, **choice)) == rows(reports.tile1_paradox(chosen))
    window = choice.get("years", (2020, 2024))
    rest = {k: v for k, v in choice.items() if k != "years"}
    assert rows(cubes.cube_tile6(cube, years=window, **rest)) == rows(reports.tile6_additive_gap(chosen, *window))
    expected = [r[:2] for r in rows(reports.nova_distribution(chosen))]
    assert rows(cubes.cube_nova(cube, **choice)) == expected


def test_the_cube_reads_staging_once_and_stays_small(spark, stg, cube, tmp_path, plan_of):
    stg.write.parquet(str(tmp_path / "stg"))
    plan = plan_of(cubes.build_cube(spark.read.parquet(str(tmp_path / "stg"))))
    assert plan.count("Exchange") == 1 and "Expand" in plan
    assert cube.filter("level = 3 AND tag IS NULL").agg(F.sum("products")).first()[0] == stg.count()


def test_tag_choices(stg, cube):
    counted = op.explode_tags(stg, "categories_tags", "tag").groupBy("tag").count()
    expected = sorted(((r["count"], r.tag) for r in counted.collect()), key=lambda x: (-x[0], x[1]))
    assert [(r.products, r.tag) for r in cubes.tag_choices(cube).collect()] == expected


def test_matching_costs_the_same_for_any_dictionary(spark):
    """Rows are not charged for the dictionary: 100,000 entries within a few seconds of 100."""
    import time

    df = spark.range(20_000).select(
        "id", F.array(*[F.concat(F.lit("t"), (F.col("id") * p) % 200_000) for p in (1, 3, 7, 11)]).alias("tags")
    )
    taken = []
    for entries in (100, 10_000, 100_000):
        dim = spark.createDataFrame([(f"t{i}",) for i in range(entries)], "tag string")
        match = op.match_dictionary(df, "id", "tags", dim, "tag", "m")
        counted = match.agg(F.count("*"), F.sum(F.size("m")))
        counted.collect()
        start = time.perf_counter()
        result = counted.first()
        taken.append(time.perf_counter() - start)
        expected = sum(len({t for p in (1, 3, 7, 11) if (t := i * p % 200_000) < entries}) for i in range(20_000))
        assert tuple(result) == (20_000, expected)
    print("seconds by entries:", [round(t, 2) for t in taken])
    assert taken[2] < taken[0] + 10
