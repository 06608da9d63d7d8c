"""Column-level functions built from Spark expressions."""

from tidemark.functions.columns import as_col, quote
from tidemark.functions.means import rounded_mean, rounded_mean_sql
from tidemark.functions.timeshift import (
    hour_floor,
    hours_before,
    ntz_literal,
    offset_seconds,
    seconds_interval,
    shift_by_offset,
    shift_by_seconds,
    utc_now_ntz,
)

__all__ = [
    "as_col", "quote", "rounded_mean", "rounded_mean_sql", "hour_floor",
    "hours_before", "ntz_literal", "offset_seconds", "seconds_interval",
    "shift_by_offset", "shift_by_seconds", "utc_now_ntz",
]
