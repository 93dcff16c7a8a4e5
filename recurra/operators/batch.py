"""Batch-generation variants.

The older flat-script generation reads pre-classified transactions: ARR is
given (rounded to 4 digits), the term is a label, the end date is derived
from it, the product comes from a literal map, and refunds are linked by a
`matchingrefund` column. Downstream it reuses the shared operators with the
`BATCH` variant.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ALL_SLICE, BATCH_TERM_MONTHS, UNMAPPED_PRODUCT, Config
from ..functions import lower_or_dash, norm, truthy
from ..sources.calendar import SpineBounds, month_spine
from .arr import customer_company_months, first_order_dates
from .monthly import arr_by_month
from .rollforward import labelled_months, slice_list
from .staging import adjusted_end_date

BATCH_ORDER_COLUMNS = (
    "customer_id", "ordernumber", "orderdate", "totalordercost", "subtypeatordertime",
    "company", "company_type", "countrycode", "state", "city", "product",
    "standardstartdate", "standardenddate",
)


def batch_product(type_id, mapping: dict[str, str]):
    """Literal type-id map, anything else 'Addon'."""
    c = F.col(type_id) if isinstance(type_id, str) else type_id
    out = None
    for k, v in mapping.items():
        out = (F.when if out is None else out.when)(c == F.lit(k), F.lit(v))
    return F.lit(UNMAPPED_PRODUCT) if out is None else out.otherwise(F.lit(UNMAPPED_PRODUCT))


def batch_end_date(term, start):
    """Term label -> end date (month arithmetic clamps to month end)."""
    t = F.upper(F.col(term))
    out = None
    for label, months in BATCH_TERM_MONTHS.items():
        e = F.add_months(start, months)
        out = (F.when if out is None else out.when)(t == F.lit(label), e)
    return out


def _round4_micros(x):
    return F.signum(x).cast("long") * F.floor(F.abs(x) * F.lit(10000) + F.lit(0.5)) * F.lit(100)


def batch_stage(classified: DataFrame, company: DataFrame, cfg: Config) -> DataFrame:
    comp = company.select(
        F.col("id").alias("_co_id"),
        norm("classification").alias("company_type"),
        norm("countrycode").alias("countrycode"),
        norm("state").alias("state"),
        norm("city").alias("city"),
    )
    j = classified.join(comp, classified["currentbillingentityid"] == comp["_co_id"], "left")
    od = F.to_date(F.convert_timezone(F.lit(cfg.source_tz), F.lit("UTC"), F.col("DATE")))
    cost_u = _round4_micros(F.col("transactionarr"))
    return j.select(
        F.col("currentbillingentityid").alias("customer_id"),
        F.col("id").alias("ordernumber"),
        od.alias("orderdate"),
        (cost_u.cast("double") / F.lit(1e6)).alias("totalordercost"),
        F.col("termlength").alias("subtypeatordertime"),
        norm("customername").alias("company"),
        "company_type",
        "countrycode",
        "state",
        "city",
        batch_product("objecttypeid", cfg.batch_product_map).alias("product"),
        od.alias("standardstartdate"),
        batch_end_date("termlength", od).alias("standardenddate"),
        cost_u.alias("_cost_u"),
        "transactionarr",
        "type",
        "matchingrefund",
    )


def _refund_ids(classified: DataFrame) -> DataFrame:
    return classified.filter(lower_or_dash("type") == "refund").select(F.col("id").alias("_ref_id"))


def batch_orders(classified: DataFrame, company: DataFrame, cfg: Config) -> DataFrame:
    """O33 (+O34, O37): paid non-refund orders with the end that O14 stretches
    (`staging.stretch_end_dates`, once the orders are laid)."""
    s = batch_stage(classified, company, cfg).filter(
        truthy((F.col("transactionarr") > 0) & (lower_or_dash("type") != "refund"))
    )
    if cfg.strict:
        refs = _refund_ids(classified)
        s = s.join(refs, s["matchingrefund"] == refs["_ref_id"], "left_anti")
    s = s.withColumn("for_product", F.explode(F.array(F.lit(ALL_SLICE))))  # a column, as in `staging.in_slices`
    return adjusted_end_date(s, F.lit(True))


def batch_refunded_arr(
    classified: DataFrame, company: DataFrame, spans: DataFrame, calendar: DataFrame, cfg: Config
) -> DataFrame:
    """Charges linked to a refund, once at their end month. `spans`: of
    the batch orders, for the first order dates."""
    s = batch_stage(classified, company, cfg).filter(truthy(F.col("transactionarr") > 0))
    refs = _refund_ids(classified)
    s = s.join(refs, s["matchingrefund"] == refs["_ref_id"], "left_semi")
    sp = month_spine(calendar)
    s = s.join(sp, F.last_day(s["standardenddate"]) == sp["pivot_month"], "inner")
    fod = first_order_dates(spans).drop("for_product")
    s = s.join(fod, "customer_id", "left")
    return s.select(
        "pivot_month",
        *BATCH_ORDER_COLUMNS,
        F.col("totalordercost").alias("refunded_arr_currency"),
        F.lit("Refunded").alias("customer_classification"),
        F.col("_first_order_date").alias("first_order_date"),
    )


def batch_first_dates(classified: DataFrame) -> DataFrame:
    """Batch 'customer since': first event date over all classified rows."""
    return classified.groupBy(F.col("currentbillingentityid").alias("customer_id")).agg(
        F.to_date(F.min("DATE")).alias("_first_date")
    ).withColumn("for_product", F.lit(ALL_SLICE))


def batch_customer_months(orders: DataFrame, bounds: SpineBounds, parts: int) -> DataFrame:
    return customer_company_months(arr_by_month(orders, bounds, keep_monthless=False), parts)


def batch_labelled_months(
    spans: DataFrame, ccm: DataFrame, classified: DataFrame, bounds: SpineBounds, parts: int
) -> DataFrame:
    """Labelled months with the batch 'customer since' rule."""
    return labelled_months(spans, ccm, slice_list(spans.sparkSession), bounds, parts, batch_first_dates(classified))
