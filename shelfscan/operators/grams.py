"""Wildcard search over postings of trigrams.

A pattern like ``%integral%`` reads every text. Kept beside the table, postings say
which rows have a run of three characters; a row that matches has all runs of the
pattern's literal pieces, so only rows with all of them are looked at, and the pattern
decides. Postings are sorted by run, and the runs asked for are pushed to their scan.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfscan.operators.filters import search

GRAM = 3

#: Lower case of these depends on their neighbours; runs with them say nothing.
_BY_CONTEXT = "σς"


def trigram_postings(df: DataFrame, row_id: str, text: str) -> DataFrame:
    """(gram, id): the rows that have each run of three characters, in lower case.

    To be written with ``materialize(.., cluster_by=["gram"])``. A run in a third of
    all texts is cut into several files there.
    """
    lowered = F.lower(F.col(text))
    starts = F.sequence(F.lit(1), F.char_length(lowered) - (GRAM - 1))
    grams = F.transform(starts, lambda i: F.substring(lowered, i, F.lit(GRAM)))
    long = df.filter(F.char_length(lowered) >= GRAM)
    return long.select(F.explode(F.array_distinct(grams)).alias("gram"), F.col(row_id).alias("id"))


def pattern_grams(spark: SparkSession, pattern: str) -> list[str]:
    """Runs that every text which a pattern matches must have; none for a pattern of short pieces."""
    lowered = spark.sql("SELECT lower(:pattern)", args={"pattern": pattern}).first()[0]
    pieces, escaped = [""], False
    for c in lowered:
        if escaped or c not in "\\%_":
            pieces[-1] += c
            escaped = False
        elif c == "\\":
            escaped = True
        else:
            pieces.append("")
    runs = {p[i : i + GRAM] for p in pieces for i in range(len(p) - GRAM + 1)}
    return sorted(r for r in runs if not any(c in r for c in _BY_CONTEXT))


def gram_search(
    df: DataFrame,
    row_id: str,
    patterns: Mapping[str, str],
    postings: Mapping[str, DataFrame],
    ignore_case: bool = True,
) -> DataFrame:
    """:func:`search` by postings of the columns; columns without, and patterns without a run, are scanned.

    Same rows as ``search``. Each column's candidates have all runs of its pattern: they
    are counted per row, after the runs have been filtered in the scan.
    """
    for column, pattern in patterns.items():
        grams = pattern_grams(df.sparkSession, pattern) if column in postings else []
        if grams:
            found = postings[column].filter(F.col("gram").isin(grams)).groupBy("id").agg(F.count("*").alias("_n"))
            candidates = found.filter(F.col("_n") == len(grams)).select(F.col("id").alias(row_id))
            df = df.join(candidates, row_id, "left_semi")
    return search(df, patterns, ignore_case)
