"""Customers with one company need no row for each month of their span: the
same facts as from all months, on one sort."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from recurra.operators import arr, rollforward
from recurra.operators.batch import batch_first_dates
from recurra.plans.pipeline import Pipeline
from recurra.sources.fixtures import fixture_config, fixture_inputs
from tests.conftest import SF_SMALL
from tests.test_hot_customer import no_broadcast, plan_of  # noqa: F401


def rows(df):
    return Counter(map(repr, df.withColumns({c: F.sort_array(c) for c in ("_facts", "_syn")}).collect()))


@pytest.fixture(scope="module", params=[500_000, 20])
def pipe(spark, request):
    inp = fixture_inputs(spark, SF_SMALL, prepare=False)
    # months that the calendar lacks: the month before is then an earlier one
    inp.calendar = inp.calendar.filter("NOT (month(ds) = 5 AND year(ds) % 2 = 0)")
    # some customers have a second company, some none
    odd = F.pmod(F.xxhash64("name"), F.lit(5))
    two = inp.company.filter(odd == 0).withColumn("name", F.lit("other"))
    inp.company = inp.company.withColumn("name", F.when(odd != 1, F.col("name"))).unionByName(two)
    return Pipeline(inp, fixture_config(hot_orders=request.param), products=True)


def test_facts_are_those_of_all_months(pipe):
    want = rows(arr.customer_facts(pipe.labelled, arr.PROCEDURE).select(*FACTS))
    got = arr.all_customer_facts(pipe.orders, pipe.spans, pipe.hot, pipe.slices, pipe.bounds, pipe.parts, arr.PROCEDURE)
    assert rows(got.select(*FACTS)) == want
    kinds = {r._companies > 1 for r in pipe.spans.select("_companies").distinct().collect()}
    assert kinds == {False, True}


def test_batch_facts_are_those_of_all_months(pipe):
    want = rows(arr.customer_facts(pipe.batch_labelled, arr.BATCH).select(*FACTS))
    first = batch_first_dates(pipe.inputs.classified)
    slices = rollforward.slice_list(pipe.spark)
    got = arr.all_customer_facts(pipe.batch_orders, pipe.batch_spans, pipe.batch_hot, slices, pipe.bounds, pipe.batch_parts, arr.BATCH, first)
    assert rows(got.select(*FACTS)) == want


def test_months_of_one_company_are_sorted_once(pipe, no_broadcast):  # noqa: F811
    lone = rollforward.with_first_date(pipe.spans.filter("_companies = 1 AND customer_id IS NOT NULL"), None)
    lone = lone.withColumn("_salt", F.lit(0).cast("long")).repartition(pipe.parts, *arr.LIE)
    plan = plan_of(arr.lone_company_facts(pipe.orders, lone, pipe.bounds, arr.PROCEDURE))
    # the windows take the order that the months were reduced in
    above = plan[: plan.index("SortAggregate")]
    assert above.count("Window [") == 2 and "Sort [" not in above.replace("SortAggregate", "") and "Union" not in plan


FACTS = ["for_product", "customer_id", "_salt", "company", "_first_order_date", "_churn_date", "_facts", "_syn", "_months"]
