"""String normalisation used for every business key comparison."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def norm(x) -> Column:
    """upper(trim(x)): the normal form of names, codes and access types."""
    return F.upper(F.trim(_c(x)))


def lower_or_dash(x) -> Column:
    """nvl(lower(x), '-'): a NULL type is neither a refund nor a charge."""
    return F.coalesce(F.lower(_c(x)), F.lit("-"))


def is_refund_type(x) -> Column:
    """lower(type) = 'refund' (NULL for a NULL type)."""
    return F.lower(_c(x)) == F.lit("refund")


def is_charge_type(x) -> Column:
    """lower(type) != 'refund' (NULL for a NULL type)."""
    return F.lower(_c(x)) != F.lit("refund")


def truthy(cond: Column) -> Column:
    """SQL WHERE/DELETE semantics: only TRUE counts, NULL is false."""
    return F.coalesce(cond, F.lit(False))
