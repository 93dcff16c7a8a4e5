"""

Each takes (spark, sf_dir), derives the subscription tables from the
driver's parquet in `sf_dir` (FIXTURES.md), writes the stage tables it reads
and returns a DataFrame whose column names equal the oracle SQL's (`recurra.plans.oracle`).
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import from_micros
from ..operators import arr as arr_ops
from ..operators import batch as batch_ops
from ..operators import legacy, rollforward, staging
from ..sources.fixtures import fixture_config, fixture_inputs
from .pipeline import Pipeline

Query = Callable[[SparkSession, str], DataFrame]


def pipeline(spark: SparkSession, sf_dir: str, products: bool = False, facts: tuple[str, ...] = ("transactions",), **cfg) -> Pipeline:
    return Pipeline(fixture_inputs(spark, sf_dir, facts=facts), fixture_config(**cfg), products=products)


def _batch(spark: SparkSession, sf_dir: str) -> Pipeline:
    return pipeline(spark, sf_dir, facts=("classified",))


def _txn(spark, sf_dir):
    return fixture_inputs(spark, sf_dir, facts=("transactions",)).transactions


# --- refund matching ------------------------------------------------------
def q_refund_match(spark, sf_dir):
    return pipeline(spark, sf_dir).refund_sets.pairs


def q_dup_refunds(spark, sf_dir):
    return pipeline(spark, sf_dir).refund_sets.dup_refunds


def q_dup_charges(spark, sf_dir):
    return pipeline(spark, sf_dir).refund_sets.dup_charges


def q_unmatched_refunds(spark, sf_dir):
    return pipeline(spark, sf_dir).refund_sets.unmatched


def q_clean_refund_map(spark, sf_dir):
    return pipeline(spark, sf_dir).refund_sets.clean


# --- staging ----------------------------------------------------------------
def q_fx_to_usd(spark, sf_dir):
    cfg = fixture_config()
    return _txn(spark, sf_dir).select(
        "id", "originalcurrencycode", staging.fx_rate("originalcurrencycode", cfg.fx).alias("fx_rate")
    )


def q_annualized_arr(spark, sf_dir):
    return pipeline(spark, sf_dir).staged.select(F.col("ordernumber").alias("id"), "totalordercost")


def q_term_bucket(spark, sf_dir):
    return _txn(spark, sf_dir).select(
        "id", staging.term_bucket("periodstart", "periodend").alias("subtypeatordertime")
    )


def q_orders_all(spark, sf_dir):
    return staging.orders_all(pipeline(spark, sf_dir).staged).select(*staging.STAGED_COLUMNS)


def q_orders_by_product(spark, sf_dir):
    return staging.orders_by_product(pipeline(spark, sf_dir).staged).select(
        "for_product", *staging.STAGED_COLUMNS
    )


def _adjusted(spark, sf_dir, grace):
    p = pipeline(spark, sf_dir, products=True, grace_days=grace)
    return p.orders.select(
        "for_product", "customer_id", "ordernumber", "standardstartdate", "standardenddate",
        "standardenddate_adjusted",
    )


def q_adjusted_end_date(spark, sf_dir):
    return _adjusted(spark, sf_dir, 0)


def q_adjusted_end_date_grace30(spark, sf_dir):
    return _adjusted(spark, sf_dir, 30)


def q_first_order_date(spark, sf_dir):
    p = pipeline(spark, sf_dir, products=True)
    return arr_ops.first_order_dates(p.spans).withColumnRenamed("_first_order_date", "first_order_date")


def q_attach_country(spark, sf_dir):
    return pipeline(spark, sf_dir).orders.select("ordernumber", "countrycode", "country_name")


# --- refund / trial facts ---------------------------------------------------
def q_refunded_arr(spark, sf_dir):
    return pipeline(spark, sf_dir).refunded_arr()


def q_not_refunded_arr(spark, sf_dir):
    return pipeline(spark, sf_dir).not_refunded_arr()


def q_trial_arr(spark, sf_dir):
    return pipeline(spark, sf_dir).trial_arr()


# --- monthly, rollforward, ARR table ---------------------------------------


def _monthly(p: Pipeline) -> DataFrame:
    return p.arr_monthly.select(
        "for_product", "pivot_month", "customer_id", "ordernumber",
        from_micros(F.col("_arr_u")).alias("arr_currency"),
        from_micros(F.col("_churn_u")).alias("churn_arr_currency"),
    )


def q_arr_by_month(spark, sf_dir):
    return _monthly(pipeline(spark, sf_dir))


def q_arr_by_month_slices(spark, sf_dir):
    return _monthly(pipeline(spark, sf_dir, products=True))


def q_registration_span(spark, sf_dir):
    return rollforward.registration_span(pipeline(spark, sf_dir, products=True).spans)


def q_rollforward(spark, sf_dir):
    return pipeline(spark, sf_dir).rollforward


def q_rollforward_slices(spark, sf_dir):
    return pipeline(spark, sf_dir, products=True).rollforward


def q_arr_classified(spark, sf_dir):
    rows = pipeline(spark, sf_dir, products=True).arr_final_full.filter("NOT _syn")
    return rows.select(
        "for_product", "pivot_month", "customer_id", "ordernumber", "company", "arr_currency",
        from_micros(F.col("_churn_u") + F.col("_interim_u")).alias("churn_arr_currency"),
        F.col("_label").alias("customer_classification"),
    )


def q_append_churn(spark, sf_dir):
    syn = pipeline(spark, sf_dir, products=True).arr_final_full.filter("_syn")
    return syn.select(
        "for_product", "pivot_month", "customer_id", "ordernumber", "company", "totalordercost",
        "standardenddate_adjusted", "arr_currency",
        from_micros(F.col("_churn_u") + F.col("_interim_u")).alias("churn_arr_currency"),
    )


def q_upgrade_downgrade_split(spark, sf_dir):
    return pipeline(spark, sf_dir, products=True).arr_final_full.select(
        "for_product", "pivot_month", "customer_id", "ordernumber",
        F.col("_label").alias("customer_classification"),
        "upgrade_currency", "downgrade_currency", "new_currency", "reactivation_currency",
    )


def q_interim_churn(spark, sf_dir):
    return pipeline(spark, sf_dir, products=True).arr_final_full.select(
        "for_product", "pivot_month", "customer_id", "ordernumber", "customer_classification",
        "churn_arr_currency", "interim_churn_arr_currency",
    )


def q_arr_final(spark, sf_dir):
    return pipeline(spark, sf_dir).arr_final


def q_product_slices(spark, sf_dir):
    return pipeline(spark, sf_dir, products=True).arr_final


# --- legacy licences --------------------------------------------------------
def q_latest_transaction(spark, sf_dir):
    return legacy.latest_transaction(_txn(spark, sf_dir))


def q_license_summary(spark, sf_dir):
    return pipeline(spark, sf_dir).license_summary


def q_legacy_tracker(spark, sf_dir):
    return pipeline(spark, sf_dir).legacy_tracker


def q_churn_for_legacy(spark, sf_dir):
    return pipeline(spark, sf_dir).churn_for_legacy()


# --- batch generation -------------------------------------------------------
def q_batch_orders(spark, sf_dir):
    return _batch(spark, sf_dir).batch_orders.select(
        *batch_ops.BATCH_ORDER_COLUMNS, "standardenddate_adjusted"
    )


def q_batch_refunded_arr(spark, sf_dir):
    return _batch(spark, sf_dir).batch_refunded_arr()


def q_batch_rollforward(spark, sf_dir):
    return _batch(spark, sf_dir).batch_rollforward()


def q_batch_arr_final(spark, sf_dir):
    return _batch(spark, sf_dir).batch_arr_final()


QUERIES: dict[str, Query] = {
    "refund_match": q_refund_match,
    "dup_refunds": q_dup_refunds,
    "dup_charges": q_dup_charges,
    "unmatched_refunds": q_unmatched_refunds,
    "clean_refund_map": q_clean_refund_map,
    "fx_to_usd": q_fx_to_usd,
    "annualized_arr": q_annualized_arr,
    "term_bucket": q_term_bucket,
    "orders_all": q_orders_all,
    "orders_by_product": q_orders_by_product,
    "refunded_arr": q_refunded_arr,
    "not_refunded_arr": q_not_refunded_arr,
    "trial_arr": q_trial_arr,
    "adjusted_end_date": q_adjusted_end_date,
    "adjusted_end_date_grace30": q_adjusted_end_date_grace30,
    "first_order_date": q_first_order_date,
    "attach_country": q_attach_country,
    "arr_by_month": q_arr_by_month,
    "arr_by_month_slices": q_arr_by_month_slices,
    "registration_span": q_registration_span,
    "rollforward": q_rollforward,
    "rollforward_slices": q_rollforward_slices,
    "arr_classified": q_arr_classified,
    "append_churn": q_append_churn,
    "upgrade_downgrade_split": q_upgrade_downgrade_split,
    "interim_churn": q_interim_churn,
    "arr_final": q_arr_final,
    "product_slices": q_product_slices,
    "latest_transaction": q_latest_transaction,
    "license_summary": q_license_summary,
    "legacy_tracker": q_legacy_tracker,
    "churn_for_legacy": q_churn_for_legacy,
    "batch_orders": q_batch_orders,
    "batch_refunded_arr": q_batch_refunded_arr,
    "batch_rollforward": q_batch_rollforward,
    "batch_arr_final": q_batch_arr_final,
}
