"""Sources and sinks."""

from shelfscan.sources.dimensions import (
    additive_families,
    additive_refs,
    category_groups,
    health_claims,
    load_seed,
    mapping_df,
)
from shelfscan.sources.ledger import fresh_files, listed_files, note_taken, read_files, read_ledger
from shelfscan.sources.products import describe_source, profile_source, read_modified_after, read_products
from shelfscan.sources.state import LoadState, append_state, high_water_marks, read_state
from shelfscan.sources.tables import (
    materialize,
    open_bucketed,
    read_table,
    write_bucketed,
    write_raw,
)

__all__ = [
    "LoadState",
    "additive_families",
    "additive_refs",
    "append_state",
    "category_groups",
    "describe_source",
    "fresh_files",
    "profile_source",
    "health_claims",
    "high_water_marks",
    "listed_files",
    "load_seed",
    "mapping_df",
    "materialize",
    "note_taken",
    "open_bucketed",
    "read_files",
    "read_ledger",
    "read_modified_after",
    "read_products",
    "read_state",
    "read_table",
    "write_bucketed",
    "write_raw",
]
