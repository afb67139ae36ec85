from __future__ import annotations

import random

import pytest

from shelfscan.operators import latest_per_key, upsert

SCHEMA = "code string, t bigint, v string, tags array<string>"


def table(spark, rows):
    return spark.createDataFrame([(*r, ["x"])[:4] if len(r) == 3 else r for r in rows], SCHEMA)


def content(df):
    return sorted((r.code, r.t, r.v) for r in df.collect())


def test_newer_replaces_older_is_ignored_new_is_added(spark):
    base = table(spark, [("a", 5, "old"), ("b", 5, "old"), ("c", 5, "old")])
    delta = table(spark, [("a", 6, "new"), ("b", 4, "late"), ("d", 1, "new")])
    merged = upsert(base, delta, ["code"], "t")
    assert content(merged) == [("a", 6, "new"), ("b", 5, "old"), ("c", 5, "old"), ("d", 1, "new")]
    assert merged.columns == base.columns


def test_the_delta_stands_at_equal_stamps(spark):
    one, other = table(spark, [("a", 5, "p")]), table(spark, [("a", 5, "q")])
    assert content(upsert(one, other, ["code"], "t")) == [("a", 5, "q")]
    assert content(upsert(other, one, ["code"], "t")) == [("a", 5, "p")]


def test_stamps_that_are_null(spark):
    known, none, other = (table(spark, [("a", t, v)]) for t, v in ((5, "p"), (None, "q"), (None, "r")))
    assert content(upsert(known, none, ["code"], "t")) == [("a", 5, "p")]
    assert content(upsert(none, known, ["code"], "t")) == [("a", 5, "p")]
    assert content(upsert(none, other, ["code"], "t")) == [("a", None, "r")]


def test_equal_stamps_within_a_delta_resolve_the_same_way(spark):
    rows = [("a", 5, "p"), ("a", 5, "q")]
    assert content(upsert(None, table(spark, rows), ["code"], "t")) == [("a", 5, "q")]
    assert content(upsert(None, table(spark, rows[::-1]), ["code"], "t")) == [("a", 5, "q")]


def test_replay_changes_nothing(spark):
    base = table(spark, [("a", 5, "p"), ("b", 5, "p")])
    delta = table(spark, [("a", 6, "q"), ("a", 7, "r"), ("c", 1, None)])
    once = upsert(base, delta, ["code"], "t")
    assert content(upsert(once, delta, ["code"], "t")) == content(once)


def test_first_load_keeps_one_row_per_key(spark):
    delta = table(spark, [("a", 6, "q"), ("a", 7, None), ("b", None, "x"), ("b", 1, "y")])
    merged = upsert(None, delta, ["code"], "t")
    assert sorted(content(merged), key=str) == [("a", 7, None), ("b", 1, "y")]


def test_null_key_raises(spark):
    with pytest.raises(Exception, match="NULL in key column code"):
        upsert(None, table(spark, [(None, 1, "x")]), ["code"], "t").collect()


def test_several_keys(spark):
    schema = "k1 int, k2 string, t int"
    base = spark.createDataFrame([(1, "a", 1), (1, "b", 1)], schema)
    delta = spark.createDataFrame([(1, "b", 2), (2, "a", 1)], schema)
    merged = upsert(base, delta, ["k1", "k2"], "t")
    assert sorted(tuple(r) for r in merged.collect()) == [(1, "a", 1), (1, "b", 2), (2, "a", 1)]


def test_against_brute_force_with_a_hot_key(spark):
    rng = random.Random(7)

    def some(n):
        codes = ["hot" if rng.random() < 0.4 else f"c{rng.randrange(60)}" for _ in range(n)]
        return [(c, rng.randrange(20), rng.choice("pqrs")) for c in codes]

    first, second = some(400), some(400)
    expected = {}
    for part in (first, second):
        newest = {}
        for code, t, v in part:
            newest[code] = max(newest.get(code, (-1, "")), (t, v))
        for code, (t, v) in newest.items():
            if t >= expected.get(code, (-1, ""))[0]:
                expected[code] = (t, v)
    base = latest_per_key(table(spark, first), ["code"], "t")
    merged = upsert(base, table(spark, second), ["code"], "t")
    assert content(merged) == sorted((c, t, v) for c, (t, v) in expected.items())


def test_a_hot_key_is_cut_to_one_row_before_the_shuffle(spark, plan_of):
    plan = plan_of(latest_per_key(table(spark, [("a", 1, "x")]), ["code"], "t"))
    shuffle = plan.index("Exchange hashpartitioning(code")
    assert "WindowGroupLimit" in plan[shuffle:]
    assert "SortAggregate" not in plan
