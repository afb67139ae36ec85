"""Functions from columns to columns."""

from shelfscan.functions.accents import brand_key, strip_accents
from shelfscan.functions.columns import (
    avgif,
    band,
    code_stem,
    countif,
    date_of,
    distinct_count,
    drop_language,
    epoch_to_date,
    epoch_to_timestamp,
    first_text,
    intersect,
    json_array,
    label,
    nonempty,
    normalize_grade,
    or_empty,
    ordinal_map,
    parse_json_array,
    present,
    rate_pct,
    safe_divide,
    share_pct,
    share_pct_raw,
    sorted_set,
    sum_case,
    sumif,
)

__all__ = [
    "avgif",
    "band",
    "brand_key",
    "code_stem",
    "countif",
    "date_of",
    "distinct_count",
    "drop_language",
    "epoch_to_date",
    "epoch_to_timestamp",
    "first_text",
    "intersect",
    "json_array",
    "label",
    "nonempty",
    "normalize_grade",
    "or_empty",
    "ordinal_map",
    "parse_json_array",
    "present",
    "rate_pct",
    "safe_divide",
    "share_pct",
    "share_pct_raw",
    "sorted_set",
    "strip_accents",
    "sum_case",
    "sumif",
]
