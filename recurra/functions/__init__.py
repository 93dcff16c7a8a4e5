"""Column-expression helpers (built-in Spark functions only, no UDFs)."""

from .dates import (
    day_boundaries,
    hour_boundaries,
    month_boundaries,
    month_starts_between,
    month_index,
    month_start,
    next_month_end,
    year_boundaries,
)
from .money import from_micros, from_units, round_half_away, round_units, to_micros
from .text import is_charge_type, is_refund_type, lower_or_dash, norm, truthy

__all__ = [
    "day_boundaries",
    "hour_boundaries",
    "month_boundaries",
    "month_starts_between",
    "month_index",
    "month_start",
    "next_month_end",
    "year_boundaries",
    "from_micros",
    "from_units",
    "round_half_away",
    "round_units",
    "to_micros",
    "is_charge_type",
    "is_refund_type",
    "lower_or_dash",
    "norm",
    "truthy",
]
