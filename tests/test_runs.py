"""Customers with one company: a row for each run of months in which the same
orders are active gives the facts of every month."""

import re

import pytest
from pyspark.sql import functions as F

from recurra.operators import arr, rollforward
from recurra.operators.batch import batch_first_dates
from recurra.plans.pipeline import Pipeline
from recurra.sources.fixtures import fixture_config, fixture_inputs
from tests.conftest import SF_SMALL
from tests.test_lone_company import FACTS, rows


@pytest.fixture(scope="module")
def pipe(spark):
    inp = fixture_inputs(spark, SF_SMALL, prepare=False)
    # unpaying and negative orders, months without orders and orders with one number
    k = F.pmod(F.xxhash64("id"), F.lit(7))
    amount = F.when(k == 0, -F.col("originalamount")).when(k == 1, F.lit(5.0)).otherwise(F.col("originalamount"))
    inp.transactions = inp.transactions.withColumn("originalamount", amount).withColumn("id", F.when(k == 2, F.lit("same")).when(k != 3, F.col("id")))
    return Pipeline(inp, fixture_config(), products=True)


def test_facts_are_those_of_all_months(pipe):
    want = rows(arr.customer_facts(pipe.labelled, arr.PROCEDURE).select(*FACTS))
    got = arr.all_customer_facts(pipe.orders, pipe.spans, pipe.hot, pipe.slices, pipe.bounds, pipe.parts, arr.PROCEDURE)
    assert rows(got.select(*FACTS)) == want and len(want) > 100


def test_batch_facts_are_those_of_all_months(pipe):
    want = rows(arr.customer_facts(pipe.batch_labelled, arr.BATCH).select(*FACTS))
    first = batch_first_dates(pipe.inputs.classified)
    got = arr.all_customer_facts(
        pipe.batch_orders, pipe.batch_spans, pipe.batch_hot, rollforward.slice_list(pipe.spark), pipe.bounds, pipe.batch_parts, arr.BATCH, first
    )
    assert rows(got.select(*FACTS)) == want and len(want) > 100


def test_runs_cover_each_orders_months_once(pipe):
    runs = arr.order_runs(pipe.orders, pipe.bounds)
    per = runs.groupBy("for_product", "_h", "_copy", "customer_id", "_n_months").agg(
        F.sum("_run").alias("n"), F.countDistinct("_at").alias("d"), F.count("*").alias("r"), F.min("_at").alias("lo"), F.max(F.col("_at") + F.col("_run")).alias("hi")
    )
    assert per.filter("n <> _n_months OR d <> r OR hi - lo <> _n_months").count() == 0
    assert 3 * runs.count() < pipe.orders.agg(F.sum("_n_months")).collect()[0][0]


def test_the_orders_plan_is_compiled(pipe):
    """The JVM leaves methods of more than 8,000 bytes of bytecode uncompiled."""
    spark = pipe.spark
    from recurra.operators import staging
    from recurra.operators.monthly import with_active_run

    o = staging.slice_orders(pipe.staged, pipe.inputs.region_dim).drop("_cost", "_dim_product", *staging.FLAGS)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = with_active_run(staging.lay_orders(o, pipe.hot, None, 4), pipe.bounds)._jdf.queryExecution().executedPlan()
        code = spark.sparkContext._jvm.org.apache.spark.sql.execution.debug.package.codegenString(plan)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000
