"""Column functions: conditional aggregates, rates, tag and date helpers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, functions as F

# Conditional aggregates. A NULL condition never counts.


def countif(condition: Column) -> Column:
    """Rows for which the condition holds; 0 on no rows."""
    return F.count_if(condition)


def sumif(condition: Column) -> Column:
    """Sum of a flag as 0/1: like :func:`countif`, but NULL on no or only-NULL input."""
    return F.sum(condition.cast("int"))


def sum_case(condition: Column) -> Column:
    """``SUM(CASE WHEN .. THEN 1 ELSE 0 END)``: NULL counts as 0, NULL on no rows."""
    return F.sum(F.when(condition, 1).otherwise(0))


def avgif(value: Column, condition: Column) -> Column:
    """Average over the rows for which the condition holds."""
    return F.avg(F.when(condition, value))


# Ratios and rates.


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Ratio as double, NULL on a zero denominator."""
    return F.try_divide(numerator, denominator)


def share_pct(condition: Column) -> Column:
    """Percentage of all rows for which the condition holds, to one decimal."""
    return F.round(F.try_divide(100.0 * F.count_if(condition), F.count("*")), 1)


def share_pct_raw(condition: Column, counted: Column) -> Column:
    """Unrounded percentage over the rows where ``counted`` is not NULL."""
    return F.try_divide(sum_case(condition), F.count(counted)) * 100


def rate_pct(flag: Column) -> Column:
    """Mean of a flag as a percentage to one decimal; NULL flags are left out."""
    return F.round(F.avg(flag.cast("int")) * 100, 1)


def distinct_count(key: Column) -> Column:
    """Exact number of distinct non-NULL keys."""
    return F.count_distinct(key)


# Collecting aggregates: for groups with few distinct values.


def sorted_set(value: Column) -> Column:
    """Distinct non-NULL values as a sorted array."""
    return F.array_sort(F.collect_set(value))


# Value rules.


def normalize_grade(grade: Column, allowed: Sequence[str]) -> Column:
    """Lower-cased grade if allowed, else NULL."""
    return F.when(F.lower(grade).isin(*allowed), F.lower(grade))


def ordinal_map(value: Column, ranks: Mapping[str, int]) -> Column:
    """Number of a known value, NULL for all others."""
    return F.coalesce(*[F.when(value == known, rank) for known, rank in ranks.items()])


def band(value: Column, thresholds: Iterable[tuple[float, str]], default: str) -> Column:
    """Name of the first threshold the value reaches, else the default."""
    reached = [F.when(value >= limit, name) for limit, name in thresholds]
    return F.coalesce(*reached, F.lit(default))


def label(codes: Column, category: Column) -> Column:
    """``A/B (category)`` from an array of codes."""
    return F.concat(F.array_join(codes, "/"), F.lit(" ("), category, F.lit(")"))


def present(text: Column) -> Column:
    """Neither NULL nor empty."""
    return text.isNotNull() & (text != "")


# Arrays and tags.


def or_empty(array: Column) -> Column:
    """The array of strings, or an empty one for NULL."""
    return F.coalesce(array, F.array().cast("array<string>"))


def nonempty(array: Column) -> Column:
    return F.size(array) > 0


def first_text(column: str) -> Column:
    """``text`` of the first struct of an array, NULL if there is none.

    Goes through the field so that only ``text`` is read from the file.
    """
    return F.get(F.col(f"{column}.text"), 0)


def intersect(tags: Column, dictionary: Column) -> Column:
    """Tags that are in the dictionary: deduplicated, in tag order, without NULL."""
    return F.array_compact(F.array_intersect(or_empty(tags), dictionary))


def drop_language(tag: Column) -> Column:
    """The tag with every ``en:`` removed."""
    return F.replace(tag, F.lit("en:"), F.lit(""))


def code_stem(tag: Column) -> Column:
    """E-number without language and suffix (``en:e450ii`` gives ``e450``), or ``''``."""
    return F.regexp_extract(drop_language(F.lower(tag)), r"^(e\d+)", 1)


def parse_json_array(text: Column) -> Column:
    """JSON text to an array of strings; malformed text gives NULL."""
    return F.from_json(text, "array<string>")


def json_array(array: Column) -> Column:
    """Array of strings to JSON text, NULL as ``[]``."""
    return F.to_json(or_empty(array))


# Dates.


def epoch_to_timestamp(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def date_of(moment: Column) -> Column:
    """Date of a timestamp in the session time zone."""
    return F.to_date(moment)


def epoch_to_date(seconds: Column) -> Column:
    """UTC date of epoch seconds, whatever the session time zone is."""
    return F.date_from_unix_date(F.floor(seconds / 86400).cast("int"))
