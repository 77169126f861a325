"""Column-level helpers. Everything here is built from native Spark expressions."""

from hrflow.functions.dates import business_days, day_diff, hours_between, iso_timestamp, trailing
from hrflow.functions.keys import surrogate_key, surrogate_key_if
from hrflow.functions.numbers import band, rank_in, round_away, safe_ratio

__all__ = [
    "band",
    "business_days",
    "day_diff",
    "hours_between",
    "iso_timestamp",
    "rank_in",
    "round_away",
    "safe_ratio",
    "surrogate_key",
    "surrogate_key_if",
    "trailing",
]
