"""Date dimension and the monthly spine derived from it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import month_index, month_start, month_starts_between, next_month_end, truthy


def day_calendar(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """One row per day `ds` in [first, last] (a generated date dimension)."""
    return spark.range(1).select(
        F.explode(
            F.sequence(F.lit(first), F.lit(last), F.expr("INTERVAL 1 DAY"))
        ).alias("ds")
    )


def month_spine(calendar: DataFrame) -> DataFrame:
    """Distinct month-ends of the calendar: (pivot_month)."""
    return calendar.select(F.last_day("ds").alias("pivot_month")).distinct()


class SpineBounds:
    """The spine's months (as month starts): first, last, and all in order.

    Exposed as scalar subqueries, so the plan stays lazy and they are computed
    once per query from a partial aggregate of the calendar; `months` holds at
    most twelve dates per calendar year. `within` keeps a generated run of
    months (between first and last) to those that the calendar has, so a month
    missing from it is missing from every expansion, as in a join to the spine;
    where none is missing the run stays as it is.
    """

    def __init__(self, calendar: DataFrame):
        agg = calendar.agg(
            F.trunc(F.min("ds"), "month").alias("lo"),
            F.trunc(F.max("ds"), "month").alias("hi"),
            F.sort_array(F.collect_set(F.trunc("ds", "month"))).alias("months"),
        )
        whole = F.size("months") == (F.year("hi") - F.year("lo")) * 12 + F.month("hi") - F.month("lo") + 1
        self.first: Column = agg.select("lo").scalar()
        self.last: Column = agg.select("hi").scalar()
        self.months: Column = agg.select("months").scalar()
        self._whole: Column = agg.select(whole.alias("whole")).scalar()

    def within(self, month_starts: Column) -> Column:
        return F.when(self._whole, month_starts).otherwise(F.array_intersect(month_starts, self.months))

    def when_whole(self, value: Column, otherwise: Column) -> Column:
        """`value` where the calendar lacks no month."""
        return F.when(self._whole, value).otherwise(otherwise)

    def place(self, month: Column) -> Column:
        """The place of a month of the spine in it, from 0."""
        past = month_index(month) - month_index(self.first)
        return self.when_whole(past, (F.array_position(self.months, F.trunc(month, "month")) - 1).cast("int"))

    def cuts(self, ends: Column) -> Column:
        """Where runs of months begin and end, in places: at `ends`; where the
        calendar lacks a month, at every one of its months, so that none is
        taken to follow another across a missing one."""
        return self.when_whole(ends, F.sequence(F.lit(0), F.size(self.months)))

    def follows(self, before: Column, month: Column) -> Column:
        """The month-end `month` is the first of the spine's after `before`."""
        between = month_starts_between(F.add_months(month_start(before), 1), F.add_months(month_start(month), -1))
        none = F.size(F.array_intersect(between, self.months)) == 0
        return truthy((next_month_end(before) == month) | (~self._whole & none))
