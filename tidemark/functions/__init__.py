"""Column functions. All of them stay in the JVM."""

from tidemark.functions.dates import parse_snapshot_date, period_ends, period_start, week_end, week_start
from tidemark.functions.minutes import minute_key, minute_of, minute_text, utc_now_text
from tidemark.functions.values import number_of_pair, pair_order, quotient_order, ratio, split_tags, spread, to_long

__all__ = [
    "minute_key",
    "minute_of",
    "minute_text",
    "number_of_pair",
    "pair_order",
    "parse_snapshot_date",
    "period_ends",
    "period_start",
    "quotient_order",
    "ratio",
    "split_tags",
    "spread",
    "to_long",
    "utc_now_text",
    "week_end",
    "week_start",
]
