"""Order staging (O06-O10, O14, O28 keying).

`stage_orders` projects every transaction once: FX conversion, annualised
cost, term bucket, normalised company attributes and product. The slice
filters (`orders_all` for the whole business, `orders_by_product` for each
product) and the adjusted end date run on that one staged table; slices are
a `for_product` column, not a loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import ALL_SLICE, TERM_MONTHLY_MAX_DAYS, TERM_YEARLY_MAX_DAYS, UNMAPPED_PRODUCT, Config
from ..functions import (
    day_boundaries,
    from_micros,
    hour_boundaries,
    lower_or_dash,
    month_boundaries,
    norm,
    to_micros,
    truthy,
)

STAGED_COLUMNS = (
    "customer_id", "ordernumber", "orderdate", "type", "totalordercost",
    "subtypeatordertime", "company", "company_type", "countrycode", "state", "city",
    "product", "originalcurrencycode", "standardstartdate", "standardenddate",
)


def fx_rate(code, fx: dict[str, float]) -> Column:
    """USD rate of upper(trim(code)); unknown/NULL -> 1."""
    rates = F.create_map(*[F.lit(x) for cur, rate in fx.items() for x in (cur, float(rate))])
    return F.coalesce(rates[norm(code)], F.lit(1.0))


def annualized_cost(amount, start, end, rate: Column) -> Column:
    """Annualised order value in USD (DOUBLE).

    Same day-of-month: 12 * amount / month boundaries (at least 1).
    Otherwise, if end >= start: 365 * amount / whole days of the hour span.
    Otherwise 0. A span under 24 hours has no whole day; the source divides
    by zero there, here the cost is NULL.
    """
    amount, start, end = (F.col(x) if isinstance(x, str) else x for x in (amount, start, end))
    usd = amount * rate
    months = month_boundaries(start, end)
    days = F.floor(hour_boundaries(start, end) / F.lit(24))
    return (
        F.when(F.dayofmonth(start) == F.dayofmonth(end),
               F.lit(12) * usd / F.when(months <= 0, F.lit(1)).otherwise(months))
        .when((F.dayofmonth(start) != F.dayofmonth(end)) & (end >= start),
              F.lit(365) * usd / F.nullif(days, F.lit(0)))
        .otherwise(F.lit(0.0))
    )


def term_bucket(start, end) -> Column:
    """Monthly / Yearly / Three Year by whole-day span; else NULL."""
    d = day_boundaries(start, end)
    return (
        F.when(d.between(0, TERM_MONTHLY_MAX_DAYS), F.lit("Monthly"))
        .when(d.between(TERM_MONTHLY_MAX_DAYS + 1, TERM_YEARLY_MAX_DAYS), F.lit("Yearly"))
        .when(d > TERM_YEARLY_MAX_DAYS, F.lit("Three Year"))
    )


def country_lookup(region: DataFrame) -> DataFrame:
    """Region dimension de-duplicated per normalised code (the source updates
    from it, which cannot fan out): (_cc_key, _region_country)."""
    return region.groupBy(norm("country_code").alias("_cc_key")).agg(
        F.min("country").alias("_region_country")
    )


def with_country(df: DataFrame, region: DataFrame, fallback: bool) -> DataFrame:
    """country_name from the region dimension on upper(trim(code)).

    Matched: coalesce(country, countrycode). Unmatched: NULL, or the code
    itself when `fallback` (the final ARR table's fix-up).
    """
    lk = country_lookup(region)
    j = df.join(lk, norm("countrycode") == lk["_cc_key"], "left")
    matched = F.coalesce(F.col("_region_country"), F.col("countrycode"))
    name = F.when(F.col("_cc_key").isNotNull(), matched)
    if fallback:
        name = F.coalesce(name, F.col("countrycode"))
    return j.withColumn("country_name", name).drop("_cc_key", "_region_country")


def stage_orders(txn: DataFrame, company: DataFrame, product_dim: DataFrame, cfg: Config) -> DataFrame:
    """O06-O08 + projection of S01's staging table, for every transaction, and
    its refund links where `txn` carries them."""
    comp = company.select(
        F.col("id").alias("_co_id"),
        norm("name").alias("company"),
        norm("classification").alias("company_type"),
        norm("countrycode").alias("countrycode"),
        norm("state").alias("state"),
        norm("city").alias("city"),
    )
    prod = product_dim.select(
        F.col("objecttypeid").alias("_p_type"), F.col("product").alias("_dim_product")
    )
    j = txn.join(comp, txn["currentbillingentityid"] == comp["_co_id"], "left").join(
        prod, txn["objecttypeid"] == prod["_p_type"], "left"
    )
    cost = annualized_cost(
        "originalamount", "periodstart", "periodend", fx_rate("originalcurrencycode", cfg.fx)
    )
    return j.select(
        F.col("currentbillingentityid").alias("customer_id"),
        F.col("id").alias("ordernumber"),
        F.to_date("DATE").alias("orderdate"),
        "type",
        cost.alias("_cost"),
        term_bucket("periodstart", "periodend").alias("subtypeatordertime"),
        "company",
        "company_type",
        comp["countrycode"],
        "state",
        "city",
        F.coalesce(F.col("_dim_product"), F.lit(UNMAPPED_PRODUCT)).alias("product"),
        "originalcurrencycode",
        F.to_date("periodstart").alias("standardstartdate"),
        F.to_date("periodend").alias("standardenddate"),
        "_dim_product",
        F.col("source").alias("transaction_source"),
        "connectedto",
        *[c for c in FLAGS if c in txn.columns],
    ).withColumn("_cost_u", to_micros(F.col("_cost"))).withColumn(
        "totalordercost", from_micros(F.col("_cost_u"))
    )


#: What `flag_refund_links` adds.
FLAGS = ("_matched", "_not_in_clean", "_unmatched_refund")


def flag_refund_links(txn: DataFrame, clean: DataFrame, unmatched: DataFrame) -> DataFrame:
    """Tag each transaction once with its refund links; before staging, since
    a transaction is a third as wide as its staged row.

    `_matched`: the order is a charge in the clean refund map.
    `_not_in_clean`: SQL `ordernumber NOT IN (clean charge ids)`, which is
    not true for a NULL order id unless the map is empty.
    `_unmatched_refund`: the order is an unmatched/ambiguous refund.
    Every later IN / NOT IN test is a filter on these columns, so the
    refund sets are joined to the transactions exactly once.
    """
    cids = clean.select(F.col("charge_id").alias("_fl_c")).distinct()
    rids = unmatched.select(F.col("refund_id").alias("_fl_r")).distinct()
    clean_empty = clean.select((F.count(F.lit(1)) == 0).alias("e")).scalar()
    s = txn.join(cids, txn["id"] == cids["_fl_c"], "left")
    s = s.join(rids, s["id"] == rids["_fl_r"], "left")
    matched = F.col("_fl_c").isNotNull()
    return s.withColumns(
        {
            "_matched": matched,
            "_not_in_clean": F.when(F.col("id").isNull(), clean_empty).otherwise(~matched),
            "_unmatched_refund": F.col("_fl_r").isNotNull(),
        }
    ).drop("_fl_c", "_fl_r")


def content_hash(columns: list[str]) -> Column:
    """64 bits of a row's content; which columns are NULL counts, too."""
    nulls = sum((F.col(c).isNull().cast("long") * (1 << k) for k, c in enumerate(columns)), F.lit(0).cast("long"))
    return F.xxhash64(*columns, nulls)


def mark_copies(rows: DataFrame, chunk: int = 1 << 20) -> DataFrame:
    """`_copy`: the number of a row within its equals, from 0 (`rows` carry
    `_h`, their `content_hash`). Where a dirty dimension or feed repeats an
    order, copy 0 carries a synthetic churn or a movement; `_h` and `_copy`
    depend on nothing but the rows, however they are partitioned.

    Rows are counted by their whole content and written out again, `chunk`
    copies at a time: one exchange, and none where `rows` are partitioned by
    some of their columns already.
    """
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n"))
    chunks = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / chunk)))
    last = F.least(F.col("_n"), (F.col("_part") + 1) * chunk) - 1
    parts = counted.withColumn("_part", chunks)
    return parts.select(*rows.columns, F.explode(F.sequence(F.col("_part") * chunk, last)).alias("_copy"))


def repeated_rows(rows: DataFrame, hot: DataFrame, most: int) -> DataFrame:
    """`_h` of the rows of which there are more than `most` (so at most one for
    each `most` rows): their copies are numbered before they are dealt, all
    others where they lie. So many equal rows make their customer one of
    `hot_customers`, so no other's rows are counted."""
    customers = hot.select(F.col("customer_id").alias("_h_cust")).distinct()
    of_hot = rows.join(customers, rows["customer_id"].eqNullSafe(customers["_h_cust"]), "left_semi")
    return of_hot.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most).select("_h")


#: What orders and customer facts meet on; none but the customer is ever NULL.
MEET = ["for_product", "customer_id", "_company_key", "_salt"]
#: How orders, customer-months and customer facts lie, from one exchange of the
#: orders on: a customer's are in one task, a hot customer's orders in several.
LIE = ["for_product", "customer_id", "_salt"]


def hot_customers(keys: DataFrame, most: int) -> DataFrame:
    """(for_product, customer_id) of more than `most` orders, with `_salts`,
    the number of parts their orders are dealt to. `keys`: one row per order;
    the result has at most one row for each `most` orders."""
    counts = keys.groupBy("for_product", "customer_id").agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") > most).select("for_product", "customer_id", F.ceil(F.col("_n") / most).alias("_salts"))


def _salts(df: DataFrame, hot: DataFrame) -> DataFrame:
    h = hot.select(F.col("for_product").alias("_h_fp"), F.col("customer_id").alias("_h_cust"), "_salts")
    on = (df["for_product"] == h["_h_fp"]) & df["customer_id"].eqNullSafe(h["_h_cust"])
    return df.join(h, on, "left").drop("_h_fp", "_h_cust").withColumn("_salts", F.coalesce("_salts", F.lit(1).cast("long")))


def company_key(company) -> Column:
    """A company, or NULL, as a string that is never NULL."""
    return F.coalesce(F.concat(F.lit("="), F.col(company)), F.lit(""))


def deal_orders(orders: DataFrame, hot: DataFrame) -> DataFrame:
    """The `MEET` columns of orders: a hot customer's are dealt by content.
    `_hot`: to more than one part."""
    dealt = F.pmod(F.xxhash64("_h", "_copy"), F.col("_salts"))
    out = _salts(orders, hot).withColumns({"_salt": dealt, "_company_key": company_key("company")})
    return out.withColumn("_hot", F.col("_salts") > 1).drop("_salts")


def lay_orders(orders: DataFrame, hot: DataFrame, repeated: DataFrame | None, parts: int) -> DataFrame:
    """Orders partitioned as they `LIE`, their copies numbered there: a copy's
    part follows from what it holds, so equal rows meet without another
    exchange. Rows `repeated` too often for that are numbered first and dealt
    copy by copy. The company's key is made where they lie, not moved."""

    def laid(df: DataFrame) -> DataFrame:
        return deal_orders(df, hot).drop("_company_key").repartition(parts, *LIE)

    zero = F.lit(0).cast("long")
    if repeated is None:
        out = mark_copies(laid(orders.withColumn("_copy", zero)).drop("_copy"))
    else:
        often = mark_copies(orders.join(repeated, "_h", "left_semi"))
        seldom = orders.join(repeated, "_h", "left_anti").withColumn("_copy", zero)
        out = mark_copies(laid(seldom).drop("_copy")).unionByName(laid(often))
    return out.withColumn("_company_key", company_key("company"))


def copy_facts(facts: DataFrame, hot: DataFrame) -> DataFrame:
    """The `MEET` columns of customer facts: a row for each part of the orders."""
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_salts") - 1))
    return _salts(facts, hot).withColumns({"_salt": each, "_company_key": company_key("company")}).drop("_salts")


def lay_facts(facts: DataFrame, hot: DataFrame, parts: int) -> DataFrame:
    """Customer facts partitioned as they `LIE`. They come so, under part 0;
    only a hot customer's are moved, a row to each part of its orders."""
    key = (facts["for_product"] == hot["for_product"]) & facts["customer_id"].eqNullSafe(hot["customer_id"])
    cold = facts.join(hot, key, "left_anti").withColumn("_company_key", company_key("company"))
    copied = copy_facts(facts.join(hot, key, "left_semi").drop("_salt"), hot).repartition(parts, *LIE)
    return cold.unionByName(copied)


def _in_all() -> Column:
    doomed = (F.col("_cost") == 0) | (lower_or_dash("type") == "refund") | F.col("_matched")
    return ~truthy(doomed)


def _in_product() -> Column:
    paid = (F.col("_cost") > 0) & (lower_or_dash("type") != "refund") & F.col("_not_in_clean")
    return truthy(paid) & F.col("_dim_product").isNotNull()


def orders_all(staged: DataFrame) -> DataFrame:
    """The whole-business slice after the staging DELETE.

    Only rows where the predicate is TRUE are removed, so NULL and negative
    costs stay (the test is `= 0`), and a NULL order id is never "in" the
    refund map.
    """
    return staged.filter(_in_all()).withColumn("for_product", F.lit(ALL_SLICE))


def orders_by_product(staged: DataFrame) -> DataFrame:
    """Per-product slices, keyed by the dimension's product name.

    Strict `cost > 0`; the slice filter binds to the dimension column, so
    unmapped (Addon) orders belong to no product slice.
    """
    return staged.filter(_in_product()).withColumn("for_product", F.col("_dim_product"))


def adjusted_end_date(orders: DataFrame, eligible: Column) -> DataFrame:
    """O14 without a grace period: the end date. Rows that are not `eligible`,
    or lack customer/order id/end date, get NULL, like the source's UPDATE that
    finds no row."""
    ok = eligible & F.col("customer_id").isNotNull() & F.col("ordernumber").isNotNull()
    return orders.withColumn("standardenddate_adjusted", F.when(truthy(ok), F.col("standardenddate")))


def lay_dates(dates: DataFrame, hot: DataFrame, parts: int) -> DataFrame:
    """Dates of customers partitioned as orders `LIE`: a row for each part that
    the customer's orders are dealt to."""
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_salts") - 1))
    return _salts(dates, hot).withColumn("_salt", each).drop("_salts").repartition(parts, *LIE)


def hot_starts(rows: DataFrame, hot: DataFrame, parts: int) -> DataFrame:
    """The start dates of `hot` customers' orders, partitioned as orders `LIE`:
    a row for each date and part that the customer's orders are dealt to."""
    key = (rows["for_product"] == hot["for_product"]) & (rows["customer_id"] == hot["customer_id"])
    of_hot = rows.filter("standardstartdate IS NOT NULL").join(hot, key, "left_semi")
    return lay_dates(of_hot.select("for_product", "customer_id", "standardstartdate").distinct(), hot, parts)


def stretch_end_dates(laid: DataFrame, grace_days: int, starts: DataFrame | None) -> DataFrame:
    """Stretch an order's adjusted end by up to `grace_days`, but not past
    the customer's next (strictly later) start within the same slice.

    The source does this with an inequality self-join and min(); here a running
    minimum over the customer's orders, latest start first, where they lie
    (`lay_orders`): nothing is moved. `starts`: `hot_starts`, where there are
    hot customers, whose orders lie in several parts."""
    if grace_days == 0:  # no stretch: max(end, min(end, next start)) is the end itself
        return laid
    rows = laid.withColumn("_order", F.lit(True))
    if starts is not None:
        rows = rows.unionByName(starts.withColumn("_order", F.lit(False)), allowMissingColumns=True)
    start, end = F.col("standardstartdate"), F.col("standardenddate_adjusted")
    w = Window.partitionBy(*LIE).orderBy(F.unix_date(start).desc_nulls_last())
    later = F.when(start.isNotNull(), F.min(start).over(w.rangeBetween(Window.unboundedPreceding, -1)))
    rows = rows.withColumn("_next_start", later).filter("_order").drop("_order")
    stretched = F.date_add(end, grace_days)
    adj = F.greatest(end, F.least(stretched, F.coalesce(F.col("_next_start"), stretched)))
    return rows.withColumn("standardenddate_adjusted", F.when(end.isNotNull(), adj)).drop("_next_start")


def slice_orders(staged: DataFrame, region: DataFrame, products: bool = True) -> DataFrame:
    """O09 (+O10 when `products`) with the end date that O14 stretches
    (`stretch_end_dates`, once the orders are laid) and country name.

    `staged` carries the refund flags (`flag_refund_links`) and is read once:
    each row goes to the slices it is in. Output: one row per (for_product,
    order); the input of O17-O27.
    """
    return with_country(adjusted_end_date(in_slices(staged, products), F.col("_cost") > 0), region, fallback=True)


def in_slices(staged: DataFrame, products: bool) -> DataFrame:
    """Each staged row once for every slice it is in. The slice is a column
    even where there is only one: a partitioning by a constant is not kept."""
    slices = [F.when(_in_all(), F.lit(ALL_SLICE))]
    if products:
        slices.append(F.when(_in_product(), F.col("_dim_product")))
    slices = F.array(*slices)
    return staged.withColumn("for_product", F.explode(F.array_compact(slices)))
