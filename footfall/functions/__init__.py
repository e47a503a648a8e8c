"""Scalar column expressions and run-parameter calculators."""

from footfall.functions.bands import dwell_section, recency_flags
from footfall.functions.parse import (
    bad_int,
    epoch_seconds,
    hour_date,
    hour_of_day,
    int_or_zero,
    jvm_trim,
    slice_stamp,
)
from footfall.functions.slices import (
    batch_stamp,
    default_start,
    default_start_col,
    last_n_slices,
    needs_reset,
    needs_reset_col,
    prefix_predicate,
    stamp_window,
    stamps_predicate,
    stay_range,
    until_now_slices,
)

__all__ = [
    "bad_int", "batch_stamp", "default_start", "default_start_col", "dwell_section",
    "epoch_seconds", "hour_date", "hour_of_day", "int_or_zero", "jvm_trim",
    "last_n_slices", "needs_reset", "needs_reset_col", "prefix_predicate",
    "recency_flags", "slice_stamp", "stamp_window", "stamps_predicate", "stay_range",
    "until_now_slices",
]
