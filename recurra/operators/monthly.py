"""Monthly expansion (O17) and the month spine.

The source range-joins every order to the month spine
(`last_day(start) <= m < last_day(adj_end)`), which Spark can only plan as a
nested-loop join. Here each order generates its own month-ends with
`sequence`, kept to the months the calendar has: a narrow Generate, no
shuffle, no join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import month_index, month_start, month_starts_between
from ..sources.calendar import SpineBounds, month_spine  # noqa: F401  (re-export)


def active_month_starts(start, end_exclusive, bounds: SpineBounds):
    """Starts of the months m with last_day(start) <= last_day(m) <
    last_day(end), within the spine (explode, then `last_day`)."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end_exclusive) if isinstance(end_exclusive, str) else end_exclusive
    lo, hi = active_ends(s, e, bounds)
    return F.when(s.isNotNull() & e.isNotNull(), bounds.within(month_starts_between(lo, hi)))


def active_ends(start: Column, end_exclusive: Column, bounds: SpineBounds) -> tuple[Column, Column]:
    """The first and the last of `active_month_starts`, if there are any."""
    return F.greatest(month_start(start), bounds.first), F.least(F.add_months(month_start(end_exclusive), -1), bounds.last)


def with_active_run(orders: DataFrame, bounds: SpineBounds) -> DataFrame:
    """`_first_month` (a month-end) and `_n_months`: where an order's active
    months begin in a run of months that has them all, and how many they are."""
    start, end = F.col("standardstartdate"), F.col("standardenddate_adjusted")
    lo, hi = active_ends(start, end, bounds)
    # step by step: expressions that are too long for one method are not compiled to machine code
    o = orders.withColumns({"_lo": F.when(end.isNotNull() & start.isNotNull(), lo), "_hi": hi})
    few = bounds.when_whole(F.lit(None).cast("array<date>"), bounds.within(month_starts_between(F.col("_lo"), F.col("_hi"))))
    o = o.withColumn("_months", few)
    n = F.greatest(bounds.when_whole(month_index("_hi") - month_index("_lo") + 1, F.size("_months")), F.lit(0))
    o = o.withColumn("_n_months", F.coalesce(F.when(F.col("_lo").isNotNull(), n), F.lit(0)))
    first = bounds.when_whole(F.col("_lo"), F.get("_months", F.lit(0)))
    return o.withColumn("_first_month", F.when(F.col("_n_months") > 0, F.last_day(first))).drop("_lo", "_hi", "_months")


def arr_by_month(orders: DataFrame, bounds: SpineBounds, keep_monthless: bool = True) -> DataFrame:
    """One row per order and active month-end.

    `_arr_u` / `_churn_u` are micro-units. With `keep_monthless` an order
    without any active month keeps one row with a NULL month (the source's
    left join); arr is then 0.
    """
    months = active_month_starts("standardstartdate", "standardenddate_adjusted", bounds)
    gen = F.explode_outer(months) if keep_monthless else F.explode(months)
    df = orders.select("*", gen.alias("_ms")).withColumn("pivot_month", F.last_day("_ms")).drop("_ms")
    end_m = F.last_day("standardenddate_adjusted")
    return df.withColumn(
        "_arr_u", F.when(F.col("pivot_month") < end_m, F.col("_cost_u")).otherwise(F.lit(0))
    ).withColumn(
        "_churn_u", F.when(F.col("pivot_month") == end_m, F.col("_cost_u")).otherwise(F.lit(0))
    )
