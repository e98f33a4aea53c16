"""Scalar column expressions (all JVM-side, no Python UDFs)."""

from casegrid.functions.bands import (
    classify_risk,
    incidence_per_100k,
    lower_threshold,
    outbreak_threshold,
    risk_priority,
    upper_threshold,
)
from casegrid.functions.calendar import month_name, month_number, month_shift, week_to_month
from casegrid.functions.names import canonical_key, disease_key, legacy_key, strip_ws
from casegrid.functions.numbers import (
    clip_zero_int,
    lenient_double,
    parse_thousands,
    round_half_even,
    strict_int,
    to_int_half_even,
)

__all__ = [
    "canonical_key", "disease_key", "legacy_key", "strip_ws",
    "lenient_double", "parse_thousands", "strict_int", "round_half_even",
    "to_int_half_even", "clip_zero_int",
    "week_to_month", "month_shift", "month_name", "month_number",
    "incidence_per_100k", "lower_threshold", "upper_threshold", "outbreak_threshold",
    "classify_risk", "risk_priority",
]
