"""Column expressions used across the jobs."""

from tidemart.functions.columns import (
    bucket_of,
    event_day,
    event_time,
    instant,
    json_field,
    null_if_zero,
    pct,
    ratio,
    value_when,
    week_of,
    within_days,
    zero_if_null,
)

__all__ = [
    "bucket_of", "event_day", "event_time", "instant", "json_field", "null_if_zero", "pct",
    "ratio", "value_when", "week_of", "within_days", "zero_if_null",
]
