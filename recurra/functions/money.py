"""Money representation.

Order-level ARR is computed in DOUBLE exactly like the source, then fixed to
integer micro-units once (`floor(x * 1e6 + 0.5)`). Every sum, lag and
difference after that is BIGINT arithmetic, so results do not depend on
shuffle order or partition count. Values leave the engine as DOUBLE
(`units / 1e6`).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000


def to_micros(x: Column) -> Column:
    return F.floor(x * F.lit(MICROS) + F.lit(0.5))


def from_micros(u: Column) -> Column:
    return u.cast("double") / F.lit(float(MICROS))


def round_units(u: Column, keep_digits: int) -> Column:
    """Round micro-units half away from zero to `keep_digits` decimals.

    Returned in units of 10**-keep_digits (integer).
    """
    step = 10 ** (6 - keep_digits)
    half = step // 2
    return F.when(
        u >= 0, F.floor((u + F.lit(half)) / F.lit(step))
    ).otherwise(-F.floor((-u + F.lit(half)) / F.lit(step)))


def from_units(u: Column, digits: int) -> Column:
    return u.cast("double") / F.lit(float(10**digits))


def round_half_away(x: Column) -> Column:
    """round(x, 0) for DOUBLE, half away from zero, written the same way the
    oracle writes it so both engines agree bit for bit."""
    return F.signum(x) * F.floor(F.abs(x) + F.lit(0.5))
