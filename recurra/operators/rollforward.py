"""Customer rollforward and movement labels.

Grain: (for_product, customer, company, month-end) for every month of a
customer-company span, plus one row per slice month that no span covers
(NULL customer), as the source's spine-left-join produces.

Scale: spans come from a partial aggregate; months come from a generator;
the only window is per (slice, customer) over at most months x companies
rows, so a customer with a huge order count does not make a huge partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import ALL_SLICE
from ..functions import from_micros, from_units, month_start, month_starts_between, round_units
from ..sources.calendar import SpineBounds
from .staging import LIE

KEY = ["for_product", "customer_id"]


def customer_spans(orders: DataFrame) -> DataFrame:
    """One pass over the orders per (slice, customer, company): O19's span and
    the first order date, and over the customer's companies the first start
    (`_first_start`), the first order date (`_first_order_date`) and how many
    they are (`_companies`). Orders are reduced where they lie (`staging.LIE`);
    only what comes out, a row for each part of a customer, is moved, once."""
    laid = orders.groupBy(*LIE, "company").agg(
        F.min("standardstartdate").alias("_start"), F.max("standardenddate_adjusted").alias("_end"), F.min("orderdate").alias("_first")
    )
    spans = laid.repartition(*KEY).groupBy(*KEY, "company").agg(
        F.min("_start").alias("client_start_date"), F.max("_end").alias("client_end_date"), F.min("_first").alias("_first")
    )
    w = Window.partitionBy(*KEY)
    return spans.withColumns(
        {
            "_first_start": F.min("client_start_date").over(w),
            "_first_order_date": F.min("_first").over(w),
            "_companies": F.count(F.lit(1)).over(w),
        }
    ).drop("_first")


def registration_span(spans: DataFrame) -> DataFrame:
    """First start and last adjusted end per (slice, customer, company)."""
    return spans.select("for_product", "customer_id", "company", "client_start_date", "client_end_date")


def churn_month_end(client_end: Column) -> Column:
    """A span ending on a month-end reaches into the next month (end + 1)."""
    return F.last_day(
        F.when(client_end == F.last_day(client_end), F.date_add(client_end, 1)).otherwise(client_end)
    )


def slice_list(spark, product_dim: DataFrame | None = None) -> DataFrame:
    """'All' plus (if given) every non-NULL dimension product: (for_product).

    A NULL product would be a slice that can never hold an order; it is
    left out on purpose.
    """
    out = spark.range(1).select(F.lit(ALL_SLICE).alias("for_product"))
    if product_dim is not None:
        prods = product_dim.select(F.col("product").alias("for_product")).filter(
            F.col("for_product").isNotNull()
        )
        out = out.union(prods).distinct()
    return out


SPAN = ["client_end_date", "_first_date", "_first_order_date"]


def _span_months(spans: DataFrame, bounds: SpineBounds) -> DataFrame:
    """`_lo` and `_hi`: the first and last month of a span within the spine."""
    cs, ce = F.col("client_start_date"), F.col("client_end_date")
    ends = {
        "_lo": F.greatest(month_start(cs), bounds.first),
        "_hi": F.least(month_start(churn_month_end(ce)), bounds.last),
    }
    return spans.filter(cs.isNotNull() & ce.isNotNull()).withColumns(ends)


def _explode_months(df: DataFrame, bounds: SpineBounds, columns: list[str]) -> DataFrame:
    months = bounds.within(month_starts_between(F.col("_lo"), F.col("_hi")))
    return df.select(*columns, F.explode(months).alias("_ms")).select(*columns, F.last_day("_ms").alias("pivot_month"))


def rollforward_base(spans: DataFrame, slices: DataFrame, bounds: SpineBounds, parts: int) -> DataFrame:
    """Spine x spans: every covered month of each span, and one NULL-customer
    row for each slice month no span covers. Which months are covered is read
    off the distinct (slice, first, last month), not off every span's months.
    Partitioned by `staging.LIE` into `parts` (`_salt` is 0); it is the spans
    that are moved, not their months."""
    ends = _span_months(spans, bounds)
    runs = ends.select("for_product", "_lo", "_hi").distinct()
    spine = slices.select("for_product", F.explode(bounds.months).alias("_lo"))
    spine = spine.withColumn("pivot_month", F.last_day("_lo"))
    empty = spine.join(_explode_months(runs, bounds, ["for_product"]), ["for_product", "pivot_month"], "left_anti")
    empty = empty.withColumn("_hi", F.col("_lo")).drop("pivot_month")
    zero = F.lit(0).cast("long")
    laid = ends.withColumn("_salt", zero).unionByName(empty.withColumn("_salt", zero), allowMissingColumns=True)
    return _explode_months(laid.repartition(parts, *LIE), bounds, [*LIE, "company", *SPAN])


def classify(arr: Column, prev: Column, chg_const: Column, month: Column, client_end: Column) -> Column:
    """The ordered movement rules (first match wins)."""
    return (
        F.when((prev.isNull() | (prev == 0)) & (arr > 0), F.lit("New"))
        .when((month == churn_month_end(client_end)) & (chg_const < 0), F.lit("Churn"))
        .when((prev > 0) & ((arr == 0) | arr.isNull()), F.lit("Churn"))
        .when((chg_const == 0) & (arr > 0), F.lit("ForEx"))
        .when((F.coalesce(prev, F.lit(0)) == 0) & (F.coalesce(arr, F.lit(0)) == 0), F.lit("-"))
        .when(chg_const < 0, F.lit("Downgrade"))
        .when(chg_const > 0, F.lit("Upgrade"))
        .otherwise(F.lit("Unknown"))
    )


#: What `arr.customer_company_months` knows of a month.
MONTH = ["_sum_u", "_tail", "_min_on", "_null_on"]


def labelled_months(
    spans: DataFrame, ccm: DataFrame, slices: DataFrame, bounds: SpineBounds, parts: int, first_dates: DataFrame | None = None
) -> DataFrame:
    """O20-O22 per (slice, customer, company, month): ARR, the ARR before, the
    label, and the month's own facts from `ccm` for the ARR table.

    Spans and month facts meet where the customer's orders lie (`staging.LIE`,
    `parts` partitions), sorted by month and company, where a month's facts are
    the row after it, and what the row before holds is the ARR before; whatever
    follows on that key (`arr.customer_facts`) reuses that one sort.
    `first_dates`: see `with_first_date`.
    """
    spans = with_first_date(spans, first_dates)
    base = rollforward_base(spans, slices, bounds, parts).withColumn("_is", F.lit(0))
    # A month of `ccm` lies in exactly one span month. The source's join on
    # customer, company and month never matches a NULL, so the rollforward's
    # ARR leaves those out; the ARR table's facts keep NULL companies.
    cm = ccm.withColumn("_is", F.lit(1))
    cm = cm.withColumn("_arr_u", F.when(F.col("company").isNotNull(), F.col("_sum_u")))
    w = Window.partitionBy(*LIE).orderBy("pivot_month", F.col("company").asc_nulls_first(), "_is")
    after = F.lead(F.struct("_is", "pivot_month", "company", "_arr_u", *MONTH)).over(w)
    rf = base.unionByName(cm, allowMissingColumns=True)
    rf = rf.withColumns({"_after": after, "_prev_u": F.lag("_arr_u").over(w)}).filter("_is = 0")
    own = (F.col("_after._is") == 1) & (F.col("_after.pivot_month") == F.col("pivot_month"))
    own = own & F.col("_after.company").eqNullSafe(F.col("company"))
    rf = rf.withColumns({c: F.when(own, F.col(f"_after.{c}")) for c in ("_arr_u", *MONTH)}).drop("_after", "_is")
    return with_label(rf)


def with_first_date(spans: DataFrame, first_dates: DataFrame | None) -> DataFrame:
    """`_first_date` of each span: from (for_product, customer_id,
    _first_date), by default the first start."""
    if first_dates is None:
        return spans.withColumn("_first_date", F.col("_first_start"))
    return spans.join(first_dates, KEY, "left")


def with_label(rf: DataFrame) -> DataFrame:
    """O21-O22 of months with their ARR and the ARR before (`_arr_u`,
    `_prev_u`): a 'New' month after the month of `_first_date` is a
    'Reactivation'."""
    arr, prev = F.col("_arr_u"), F.col("_prev_u")
    zero = F.lit(0)
    rf = rf.withColumn(
        "_chg_c5", F.coalesce(round_units(arr, 5), zero) - F.coalesce(round_units(prev, 5), zero)
    ).withColumn("_label", classify(arr, prev, F.col("_chg_c5"), F.col("pivot_month"), F.col("client_end_date")))
    react = (F.col("_label") == "New") & (F.col("pivot_month") > F.last_day("_first_date"))
    return rf.withColumn(
        "_label", F.when(F.coalesce(react, F.lit(False)), F.lit("Reactivation")).otherwise(F.col("_label"))
    )


def rollforward(labelled: DataFrame, source_label: str) -> DataFrame:
    """The published rollforward."""
    arr, prev, zero = F.col("_arr_u"), F.col("_prev_u"), F.lit(0)
    return labelled.select(
        "for_product",
        F.lit(source_label).alias("source"),
        "customer_id",
        "pivot_month",
        "company",
        "client_end_date",
        from_micros(arr).alias("arr_spot_rate_usd"),
        from_micros(prev).alias("arr_spot_rate_usd_prev"),
        from_micros(F.coalesce(arr, zero) - F.coalesce(prev, zero)).alias("arr_spot_rate_usd_change"),
        from_micros(arr).alias("arr_const_curr_py_usd"),
        from_micros(prev).alias("arr_const_curr_py_usd_prev"),
        from_units(F.col("_chg_c5"), 5).alias("arr_const_curr_py_usd_change"),
        F.col("_label").alias("customer_classification"),
    )
