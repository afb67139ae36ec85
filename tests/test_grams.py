"""Wildcard search by trigram postings finds what a scan finds."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from shelfscan import operators as op
from shelfscan.sources import materialize

TEXTS = ["Leite Integral 1", "LEITE Semi Integral", "leite", "", None, "100% pão_de queijo", "ab", "ΟΔΟΣΑ οδός", "İstanbul", "🎉🎉🎉🎉", "a\\b%c"]
PATTERNS = [
    "%integral%", "Leite%Integral%", "leite", "%", "", "ab", "_b", "%b", "%pão%", "%100\\%%", "%o\\_de%", "%ΟΔΟΣ%", "%οδοσ%", "%istan%",
    "%İst%", "%🎉🎉🎉%", "%nothing%", "Le_te%", "%a\\\\b%",
]


@pytest.fixture(scope="module")
def df(spark):
    rng = random.Random(3)
    some = ["".join(rng.choices("abcÃã %_", k=rng.randint(0, 12))) for _ in range(300)]
    return spark.createDataFrame(list(enumerate(TEXTS + some)), "id int, text string").persist()


@pytest.mark.parametrize("ignore_case", [True, False])
def test_same_rows_as_a_scan(spark, df, ignore_case):
    postings = {"text": op.trigram_postings(df, "id", "text").persist()}
    for pattern in [*PATTERNS, "%abc%", "%a_c%bca%", "%Ãa%"]:
        got, expected = (
            sorted(r.id for r in f.collect())
            for f in (
                op.gram_search(df, "id", {"text": pattern}, postings, ignore_case),
                op.search(df, {"text": pattern}, ignore_case),
            )
        )
        assert got == expected, pattern


def test_runs_of_a_pattern(spark):
    assert op.pattern_grams(spark, "Leite%In_egr%") == ["egr", "eit", "ite", "lei"]
    assert op.pattern_grams(spark, "%ab%_c") == []
    assert op.pattern_grams(spark, "a\\%b") == ["a%b"]


def test_only_the_runs_asked_for_are_read(spark, df, tmp_path, plan_of):
    path = str(tmp_path / "postings")
    materialize(op.trigram_postings(df, "id", "text"), path, cluster_by=["gram"])
    kept = {"text": spark.read.parquet(path)}
    found = op.gram_search(df, "id", {"text": "%integral%"}, kept)
    plan = plan_of(found)
    assert "In(gram, [" in plan and "LeftSemi" in plan and "Cartesian" not in plan
    assert sorted(r.id for r in found.collect()) == [0, 1]
    assert "gram" not in plan_of(op.gram_search(df, "id", {"text": "%ab%"}, kept))


def test_a_run_in_every_text_is_split(spark, tmp_path):
    """Postings of one hot run lie in several files."""
    rows = spark.range(0, 60_000, 1, 4).select("id", F.concat(F.lit("aaa"), F.col("id")).alias("text"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32KB")
    try:
        materialize(op.trigram_postings(rows, "id", "text"), str(tmp_path / "p"), cluster_by=["gram"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    hot = spark.read.parquet(str(tmp_path / "p")).filter("gram = 'aaa'")
    assert hot.count() == 60_000 and hot.select(F.input_file_name()).distinct().count() > 1
