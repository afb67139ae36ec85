"""Operators from DataFrames to DataFrames."""

from shelfscan.operators.aggregates import (
    daily_counts,
    group_mode,
    min_support,
    share_of_total,
    top_k,
)
from shelfscan.operators.bitmaps import count_distinct_bitmaps, dense_numbers, distinct_bitmaps, merge_bitmaps
from shelfscan.operators.checks import ChecksFailed, check_json_arrays, check_table, require
from shelfscan.operators.filters import (
    cross_filter,
    in_scope,
    scope_filter,
    search,
    select_except,
    since,
    with_controls,
)
from shelfscan.operators.grams import gram_search, pattern_grams, trigram_postings
from shelfscan.operators.merge import changes, latest_per_key, upsert
from shelfscan.operators.tags import (
    arrays_to_json,
    explode_tags,
    match_dictionary,
    match_joined,
    tag_join,
)

__all__ = [
    "ChecksFailed",
    "arrays_to_json",
    "changes",
    "check_json_arrays",
    "check_table",
    "count_distinct_bitmaps",
    "cross_filter",
    "daily_counts",
    "dense_numbers",
    "distinct_bitmaps",
    "explode_tags",
    "gram_search",
    "group_mode",
    "in_scope",
    "latest_per_key",
    "match_dictionary",
    "match_joined",
    "merge_bitmaps",
    "min_support",
    "pattern_grams",
    "require",
    "scope_filter",
    "search",
    "select_except",
    "share_of_total",
    "since",
    "tag_join",
    "top_k",
    "trigram_postings",
    "upsert",
    "with_controls",
]
