"""Calendar arithmetic with boundary-counting semantics.

The source warehouse's DATEDIFF / TIMESTAMPDIFF count unit *boundaries*
crossed (Jan 31 -> Feb 1 is one month), whereas Spark's `months_between` /
`timestamp_diff` count complete units. These helpers give the boundary form
with built-in expressions only. Timestamps are wall-clock (TIMESTAMP_NTZ) so
results never depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def month_index(d) -> Column:
    """Months since year 0 of a date/timestamp: year*12 + month."""
    d = _c(d)
    return F.year(d) * 12 + F.month(d)


def month_boundaries(start, end) -> Column:
    """Month boundaries crossed from start to end (negative if reversed)."""
    return month_index(end) - month_index(start)


def hour_boundaries(start, end) -> Column:
    """Hour boundaries crossed between two wall-clock timestamps."""
    return day_boundaries(start, end).cast("long") * 24 + F.hour(_c(end)) - F.hour(_c(start))


def day_boundaries(start, end) -> Column:
    """Calendar-day boundaries crossed (date(end) - date(start))."""
    return F.datediff(F.to_date(_c(end)), F.to_date(_c(start)))


def year_boundaries(start, end) -> Column:
    return F.year(_c(end)) - F.year(_c(start))


def month_start(d) -> Column:
    return F.trunc(_c(d), "month")


def next_month_end(month_end) -> Column:
    """Month-end of the month after a month-end: last_day(d + 1 day)."""
    return F.last_day(F.date_add(_c(month_end), 1))


def month_starts_between(lo_start, hi_start) -> Column:
    """Array of month starts lo..hi inclusive; NULL if empty.

    Explode it and take `last_day` for month-ends. `sequence` raises when
    stop < start, so the guard is required.
    """
    seq = F.sequence(lo_start, hi_start, F.expr("INTERVAL 1 MONTH"))
    return F.when(lo_start.isNotNull() & hi_start.isNotNull() & (lo_start <= hi_start), seq)
