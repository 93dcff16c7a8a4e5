"""Refunded, not-refunded and trial ARR facts.

All three read the staged table *before* the staging DELETE and place rows on
the month spine by an equi-join, which the planner broadcasts when its own
size check allows it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import from_micros, is_charge_type, lower_or_dash, truthy
from ..sources.calendar import SpineBounds, month_spine
from .monthly import active_month_starts
from .staging import STAGED_COLUMNS, with_country

TAIL = ("first_order_date", "country_name", "transaction_source", "connectedto")


def paid_first_order_dates(staged: DataFrame) -> DataFrame:
    """O15 (refund tables): min order date per customer over paid,
    non-refund, unmatched orders: (customer_id, first_order_date)."""
    paid = staged.filter(
        truthy((F.col("_cost") > 0) & (lower_or_dash("type") != "refund") & F.col("_not_in_clean"))
    )
    return paid.groupBy("customer_id").agg(F.min("orderdate").alias("first_order_date"))


def _enrich(df: DataFrame, region: DataFrame, first_dates: DataFrame | None) -> DataFrame:
    if first_dates is not None:
        df = df.join(first_dates, "customer_id", "left")
    return with_country(df, region, fallback=False)


def refunded_arr(staged: DataFrame, calendar: DataFrame, region: DataFrame) -> DataFrame:
    """Each refunded charge once, at the month-end of its end date."""
    r = staged.filter(truthy(F.col("_cost") > 0) & F.col("_matched"))
    sp = month_spine(calendar)
    r = r.join(sp, F.last_day(r["standardenddate"]) == sp["pivot_month"], "inner")
    r = r.withColumns(
        {
            "refunded_arr_currency": F.col("totalordercost"),
            "customer_classification": F.lit("Refunded"),
        }
    )
    r = _enrich(r, region, paid_first_order_dates(staged))
    return r.select(
        "pivot_month", *STAGED_COLUMNS, "refunded_arr_currency", "customer_classification", *TAIL
    )


def not_refunded_arr(staged: DataFrame, bounds: SpineBounds, region: DataFrame) -> DataFrame:
    """unmatched/ambiguous refunds as negative ARR over their months."""
    r = staged.filter(truthy(F.col("_cost") > 0) & F.col("_unmatched_refund"))
    months = active_month_starts("standardstartdate", "standardenddate", bounds)
    r = r.select("*", F.explode(months).alias("_ms")).withColumn("pivot_month", F.last_day("_ms")).drop("_ms")
    r = r.withColumns(
        {
            "not_refunded_arr_currency": from_micros(-F.col("_cost_u")),
            "customer_classification": F.lit("Not Refunded"),
        }
    )
    r = _enrich(r, region, paid_first_order_dates(staged))
    return r.select(
        "pivot_month", *STAGED_COLUMNS, "not_refunded_arr_currency", "customer_classification", *TAIL
    )


def trial_arr(staged: DataFrame, calendar: DataFrame, region: DataFrame) -> DataFrame:
    """Zero-cost, non-refund, unmatched orders at their start month."""
    t = staged.filter(truthy((F.col("_cost") == 0) & is_charge_type("type") & F.col("_not_in_clean")))
    sp = month_spine(calendar)
    t = t.join(sp, F.last_day(t["standardstartdate"]) == sp["pivot_month"], "inner")
    t = t.withColumns(
        {"trial_arr_currency": F.lit(0.0), "customer_classification": F.lit("Trial")}
    )
    t = _enrich(t, region, None)
    return t.select(
        "pivot_month", *STAGED_COLUMNS, "trial_arr_currency", "customer_classification",
        "country_name", "transaction_source", "connectedto",
    )
