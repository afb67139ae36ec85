"""Operators on tag arrays: exploding, mapping, matching against a dictionary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from shelfscan.functions import intersect, json_array, or_empty


def explode_tags(df: DataFrame, tags: str, alias: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per tag with the columns to keep; rows without tags drop out.

    Filter before calling and keep only what is used after: the rest would be
    copied once per tag.
    """
    return df.select(*keep, F.explode(tags).alias(alias))


def tag_join(df: DataFrame, mapping: DataFrame, key: str, tag: str) -> DataFrame:
    """Inner join of a tag column with a mapping of tags.

    No hint is given. Spark broadcasts the mapping while its size is below the
    broadcast limit; a larger one is sort-merge joined, with hot tags split by
    the adaptive skew join.
    """
    return df.join(mapping.withColumnRenamed(tag, key), key)


def _known_bytes(df: DataFrame) -> int:
    """The planner's size of a relation, known before anything runs."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


#: Bytes of a dictionary that may become an array in the plan (some 300 tags): every row builds a set of it.
ARRAY_BYTES = 16 << 10


def match_dictionary(
    df: DataFrame, row_id: str, tags: str, dictionary: DataFrame, key: str, alias: str
) -> DataFrame:
    """Adds each row's distinct tags that are in a dictionary of any size, in the row's order.

    ``row_id`` must be unique. A dictionary whose planned size is at most
    ``ARRAY_BYTES`` becomes one array in the plan, and nothing moves. For another
    one, ids and tags go through a semi join, with the dictionary broadcast up to
    the session's limit, and the matches come back to their rows by id; over a table
    bucketed by the id the wide rows don't move either. So the cost of a row does not
    depend on the dictionary's size. Both give the same rows.
    """
    if _known_bytes(dictionary) <= ARRAY_BYTES:
        entries = dictionary.select(key).agg(F.collect_list(key)).scalar()
        return df.withColumn(alias, intersect(F.col(tags), entries))
    return match_joined(df, row_id, tags, dictionary, key, alias)


def match_joined(
    df: DataFrame, row_id: str, tags: str, dictionary: DataFrame, key: str, alias: str
) -> DataFrame:
    """:func:`match_dictionary` by joins, whatever the size of the dictionary."""
    tagged = df.select(row_id, F.posexplode(tags).alias("_place", key))
    found = tagged.join(dictionary.select(key), key, "left_semi")
    first = found.groupBy(row_id, key).agg(F.min("_place").alias("_place"))
    in_order = F.array_sort(F.collect_list(F.struct("_place", key)))
    matched = first.groupBy(row_id).agg(F.transform(in_order, lambda x: x[key]).alias(alias))
    return df.join(matched, row_id, "left").withColumn(alias, or_empty(F.col(alias)))


def arrays_to_json(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Array columns as JSON text, NULL as ``[]``."""
    return df.withColumns({name: json_array(F.col(name)) for name in columns})
