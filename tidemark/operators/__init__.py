"""Frame operators that the plans are built from."""

from tidemark.operators.grouping import cumulative_gain, explode_periods, explode_tags, with_week_bounds
from tidemark.operators.joins import join_small, null_safe_join, with_name
from tidemark.operators.nesting import as_document, nest
from tidemark.operators.ranking import first_per_key, top_k, top_n_per_group

__all__ = [
    "as_document",
    "cumulative_gain",
    "explode_periods",
    "explode_tags",
    "first_per_key",
    "join_small",
    "nest",
    "null_safe_join",
    "top_k",
    "top_n_per_group",
    "with_name",
    "with_week_bounds",
]
