"""Legacy-licence analytics.

Per-licence top-1 and per-licence summaries are aggregates (partial
aggregation before the shuffle), not windows over a licence's rows, so a
licence with a huge history does not land in one task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import UNMAPPED_PRODUCT, PriceRules
from ..functions import norm, round_half_away, truthy, year_boundaries

SUMMARY_KEYS = (
    "licenseid", "companyid", "country", "companyname", "product", "accesstype",
    "latesttransactiondate", "latesttransactioncurrency", "latesttransactionamount",
    "latesttransaction_years", "latesttransactionamount_per_yr",
    "latesttransactiononstripe", "legacy_status",
)
SUMMARY_COLUMNS = SUMMARY_KEYS + ("first_license_purchase_date", "currentexpirationdate")
TRACKER_COLUMNS = SUMMARY_COLUMNS + (
    "renewal_price_stage1", "renewal_price_stage2", "renewal_price_stage3", "renewal_status",
)
def _newest() -> Column:
    """Sort key and attributes of a transaction; the largest is the newest: a
    NULL date counts as newest (descending order puts NULLs first in the
    source dialect), ties go to the larger id."""
    return F.struct(
        F.col("DATE").isNull().alias("_k0"),
        F.col("DATE").alias("_k1"),
        F.col("id").alias("_k2"),
        F.col("source"),
        year_boundaries(F.to_date("periodstart"), F.to_date("periodend")).cast("long").alias("n_years"),
        F.col("originalamount"),
        F.col("originalcurrencycode"),
    )


def _newest_columns(top: DataFrame) -> DataFrame:
    return top.select(
        "objectid",
        F.col("_t.source").alias("source"),
        F.col("_t._k1").alias("DATE"),
        F.col("_t.n_years").alias("n_years"),
        F.col("_t.originalamount").alias("originalamount"),
        F.col("_t.originalcurrencycode").alias("originalcurrencycode"),
    )


def latest_transaction(txn: DataFrame) -> DataFrame:
    """Newest transaction of each licence (any type)."""
    return _newest_columns(txn.groupBy("objectid").agg(F.max(_newest()).alias("_t")))


def _paid() -> Column:
    """The type test is case-sensitive (`type != 'Refund'`) and drops NULL
    types, as in the source."""
    return truthy((F.col("originalamount") > 0) & (F.col("type") != "Refund"))


def licence_facts(txn: DataFrame) -> DataFrame:
    """One pass over the transactions for O30-O32: a row per (licence,
    customer, type id, access type) with its first date, last end, newest
    transaction and first paid start."""
    return txn.groupBy("objectid", "currentbillingentityid", "objecttypeid", "objectaccesstype").agg(
        F.min("DATE").alias("_min_date"),
        F.max("periodend").alias("_max_end"),
        F.max(_newest()).alias("_t"),
        F.min(F.when(_paid(), F.to_date("periodstart"))).alias("_since"),
    )


def license_summary(
    facts: DataFrame,
    company: DataFrame,
    legacy_licenses: DataFrame,
    product_dim: DataFrame,
    region: DataFrame,
) -> DataFrame:
    """One row per licence and attribute combination.

    Every grouping attribute is a function of the keys of `licence_facts` plus
    the dimension joins, so the joins see one row per licence key, not one per
    transaction.
    """
    # the newest of a licence is the newest of its pre-aggregated rows: no second pass over the transactions
    lt = _newest_columns(facts.groupBy("objectid").agg(F.max("_t").alias("_t"))).withColumnRenamed("objectid", "_lt_obj")
    pre = facts.drop("_t", "_since")
    comp = company.select(
        F.col("id").alias("_b_id"), F.col("name").alias("_b_name"), F.col("countrycode").alias("_b_cc")
    )
    leg = legacy_licenses.select(F.col("licenseid").alias("_leg_id"))
    prod = product_dim.select(F.col("objecttypeid").alias("_p_type"), F.col("product").alias("_p_product"))
    reg = region.select(F.col("country_code").alias("_r_code"), F.col("country").alias("_r_country"))
    j = (
        pre.join(comp, pre["currentbillingentityid"] == comp["_b_id"], "left")
        .join(lt, pre["objectid"] == lt["_lt_obj"], "left")
        .join(leg, pre["objectid"] == leg["_leg_id"], "left")
        .join(prod, pre["objecttypeid"] == prod["_p_type"], "left")
    )
    j = j.join(reg, norm(j["_b_cc"]) == norm(reg["_r_code"]), "left")
    amount = F.col("originalamount")
    years = F.col("n_years")
    keyed = j.select(
        F.col("objectid").alias("licenseid"),
        F.col("_b_id").alias("companyid"),
        F.coalesce(F.col("_r_country"), F.col("_b_cc")).alias("country"),
        F.col("_b_name").alias("companyname"),
        F.coalesce(F.col("_p_product"), F.lit(UNMAPPED_PRODUCT)).alias("product"),
        F.col("objectaccesstype").alias("accesstype"),
        F.to_date("DATE").alias("latesttransactiondate"),
        F.col("originalcurrencycode").alias("latesttransactioncurrency"),
        amount.alias("latesttransactionamount"),
        years.alias("latesttransaction_years"),
        F.when(years >= 1, amount / years).otherwise(amount).alias("latesttransactionamount_per_yr"),
        truthy(F.lower("source") == "stripe").alias("latesttransactiononstripe"),
        F.when(F.col("_leg_id").isNotNull(), F.lit("Legacy")).otherwise(F.lit("Not Legacy")).alias("legacy_status"),
        "_min_date",
        "_max_end",
    )
    return keyed.groupBy(*SUMMARY_KEYS).agg(
        F.to_date(F.min("_min_date")).alias("first_license_purchase_date"),
        F.to_date(F.max("_max_end")).alias("currentexpirationdate"),
    )


def _in(col: Column, values) -> Column:
    values = list(values)
    return col.isin(values) if values else F.lit(False)


def legacy_tracker(summary: DataFrame, price_grid: DataFrame, rules: PriceRules) -> DataFrame:
    """Price-rise ladder and renewal status of each legacy licence.

    The rules name the products it applies to; without them the result would
    be empty whatever the data hold, so that is an error.
    """
    if not rules.legacy_products:
        raise ValueError("PriceRules.legacy_products is empty: name the legacy products")
    res = summary.filter(
        _in(F.col("product"), rules.legacy_products) & (F.col("legacy_status") == "Legacy")
    )
    grid = price_grid.select(
        norm("currency_code").alias("_g_cur"),
        norm("product").alias("_g_prod"),
        norm("objectaccesstype").alias("_g_acc"),
        "price_th1",
        "price_th2",
        "price_th3",
    )
    j = res.join(
        grid,
        (norm(res["latesttransactioncurrency"]) == grid["_g_cur"])
        & (norm(res["product"]) == grid["_g_prod"])
        & (norm(res["accesstype"]) == grid["_g_acc"]),
        "left",
    )
    override = _in(F.col("companyid"), rules.override_company_ids)
    training = F.lower("product") == F.lit((rules.training_product or "").lower())
    cur = F.col("latesttransactioncurrency")
    acc = F.col("accesstype")
    th1, th2, th3 = F.col("price_th1"), F.col("price_th2"), F.col("price_th3")
    stage1 = (
        F.when(override, F.lit(rules.stage1_factor) * th3)
        .when(training & _in(cur, rules.training_multi_currencies) & acc.ilike("multi%"),
              F.lit(float(rules.training_multi_price)))
        .when(training & _in(cur, rules.training_single_currencies) & acc.ilike("single%"),
              F.lit(float(rules.training_single_price)))
        .otherwise(th1)
    )
    stage2 = F.when(override, F.lit(rules.stage2_factor) * th3).otherwise(th2)
    j = j.withColumns(
        {"renewal_price_stage1": stage1, "renewal_price_stage2": stage2, "renewal_price_stage3": th3}
    )
    paid = round_half_away(F.col("latesttransactionamount_per_yr")) + F.lit(rules.tolerance)
    r1, r2, r3 = (round_half_away(F.col(f"renewal_price_stage{i}")) for i in (1, 2, 3))
    status = (
        F.when(paid < r1, F.lit("Not Started"))
        .when(paid < r2, F.lit("Stage 1 Completed"))
        .when(paid < r3, F.lit("Stage 2 Completed"))
        .when(paid >= r3, F.lit("Stage 3 Completed"))
    )
    return j.withColumn("renewal_status", status).select(*TRACKER_COLUMNS)


def churn_for_legacy(
    txn: DataFrame,
    facts: DataFrame,
    tracker: DataFrame,
    company: DataFrame,
    product_dim: DataFrame,
    as_of: dt.date,
) -> DataFrame:
    """Paid transactions of companies that own a legacy licence; who has
    been a customer since when comes from `licence_facts`. `as_of` replaces
    current_date().
    """
    paid = txn.filter(_paid())
    since = facts.groupBy(F.col("currentbillingentityid").alias("_d_cust")).agg(F.min("_since").alias("customer_since"))
    owners = tracker.select(F.col("companyid").alias("_own"))
    a = paid.join(owners, paid["currentbillingentityid"] == owners["_own"], "left_semi")
    lic = tracker.select(F.col("licenseid").alias("_b_lic"))
    comp = company.select(F.col("id").alias("_c_id"), F.col("name").alias("_c_name"))
    prod = product_dim.select(F.col("objecttypeid").alias("_p_type"), F.col("product").alias("_p_product"))
    j = (
        a.join(lic, a["objectid"] == lic["_b_lic"], "left")
        .join(comp, a["currentbillingentityid"] == comp["_c_id"], "left")
        .join(since, a["currentbillingentityid"] == since["_d_cust"], "left")
        .join(prod, a["objecttypeid"] == prod["_p_type"], "left")
    )
    active = truthy(F.col("periodend") >= F.lit(as_of).cast("timestamp_ntz"))
    return j.select(
        F.col("_c_name").alias("companyname"),
        F.col("currentbillingentityid").alias("companyid"),
        F.to_date("DATE").alias("orderdate"),
        F.col("objectid").alias("licenseid"),
        "originalamount",
        F.coalesce(F.col("_p_product"), F.lit(UNMAPPED_PRODUCT)).alias("product"),
        F.when(F.col("_b_lic").isNotNull(), F.lit("Legacy")).otherwise(F.lit("Not Legacy")).alias("license_cohort"),
        F.when(active, F.lit(1)).otherwise(F.lit(0)).alias("current_license_status_num"),
        F.when(active, F.lit("Active")).otherwise(F.lit("Expired")).alias("current_license_status"),
        "customer_since",
    )
