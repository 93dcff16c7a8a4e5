"""What is moved on the way to the orders and from them: spans once, no
column that can be made where the orders lie, no count of copies where no
customer is hot."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from recurra.functions import from_micros
from recurra.operators import rollforward, staging
from recurra.plans.pipeline import Pipeline
from recurra.sources.fixtures import fixture_config, fixture_inputs
from tests.conftest import SF_SMALL
from tests.test_hot_customer import no_broadcast, plan_of  # noqa: F401
from tests.test_one_exchange import moves


@pytest.fixture(scope="module")
def inputs(spark):
    return fixture_inputs(spark, SF_SMALL, prepare=False)


def exchanges(plan):
    return [x for x in plan.splitlines() if "Exchange" in x]


def test_spans_are_moved_once(inputs, no_broadcast):  # noqa: F811
    p = Pipeline(inputs, fixture_config())
    assert len(exchanges(plan_of(rollforward.customer_spans(p.orders)))) == 1
    p.drop_stages()


def test_spans_of_a_customer_in_several_parts(spark):
    rows = [
        ("All", c, s, co, f"2001-0{m}-01", None if m == 3 else f"2002-0{m}-01", f"2000-0{m}-01")
        for c in ("a", "b", None)
        for s, m, co in ((0, 1, "x"), (0, 2, None), (1, 3, "x"), (2, 4, None), (2, 4, None))
    ]
    df = spark.createDataFrame(rows, "for_product string, customer_id string, _salt long, company string, s string, e string, d string")
    df = df.select(*staging.LIE, "company", *[F.to_date(a).alias(b) for a, b in (("s", "standardstartdate"), ("e", "standardenddate_adjusted"), ("d", "orderdate"))])
    got = {(r.customer_id, r.company): list(map(str, r[3:])) for r in rollforward.customer_spans(df).collect()}
    for c in ("a", "b", None):
        assert got.pop((c, "x")) == ["2001-01-01", "2002-01-01", "2001-01-01", "2000-01-01", "2"]
        assert got.pop((c, None)) == ["2001-02-01", "2002-04-01", "2001-01-01", "2000-01-01", "2"]
    assert not got


def test_company_key_is_not_moved(spark, inputs):
    p = Pipeline(inputs, fixture_config())
    laid = staging.lay_orders(staging.in_slices(p.staged, True), p.hot, None, 4)
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")  # else a node names its first columns only
    plan = plan_of(laid)
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert "_company_key" in plan and "_company_key" not in plan[plan.index("Exchange") :]
    p.drop_stages()


@pytest.mark.parametrize("most", [3, 500_000])
def test_copies_are_counted_for_hot_customers_only(spark, inputs, most):
    p = Pipeline(inputs, fixture_config(hot_orders=most))
    orders = p.orders
    assert ("repeated" in p._paths) == (not p.hot.isEmpty()) == (most == 3)
    assert orders.filter(~F.col("totalordercost").eqNullSafe(from_micros(F.col("_cost_u")))).count() == 0
    p.drop_stages()


def test_rows_repeated_are_those_of_any_customer(spark):
    """As a count of all rows finds them, a customer that is NULL included."""
    given = [("a", "o", 6), ("b", "o", 2), ("c", "p", 5), (None, "o", 7), (None, "q", 1)]
    rows = spark.createDataFrame([(c, o) for c, o, n in given for _ in range(n)], "customer_id string, ordernumber string")
    rows = rows.withColumn("_h", staging.content_hash(rows.columns))
    hot = staging.hot_customers(rows.withColumn("for_product", F.lit("All")), 4)
    often = staging.repeated_rows(rows, hot, 4)
    got = Counter((r.customer_id, r.ordernumber) for r in rows.join(often, "_h", "left_semi").collect())
    assert got == {("a", "o"): 6, ("c", "p"): 5, (None, "o"): 7}


def test_batch_orders_are_staged_once(inputs):
    p = Pipeline(inputs, fixture_config())
    p.batch_hot  # noqa: B018
    assert set(p._paths) == {"batch-staged", "batch-hot-customers"}
    assert "totalordercost" in p.batch_orders.columns and not {"transactionarr", "matchingrefund"} & set(p.batch_orders.columns)
    p.drop_stages()


def test_batch_orders_without_months_are_not_moved(inputs, no_broadcast):  # noqa: F811
    p = Pipeline(inputs, fixture_config())
    assert not any(moves(plan_of(p.batch_arr_final()), "recurra_batch_orders"))
    p.drop_stages()


def test_first_order_date_of_a_hot_customer_without_months(inputs):
    """The same rows, however many parts a customer's orders are dealt to."""

    def run(most):
        p = Pipeline(inputs, fixture_config(hot_orders=most))
        out = Counter(map(repr, p.batch_arr_final().collect()))
        dealt = p.batch_orders.filter("_n_months = 0 AND _salt > 0").count()
        p.drop_stages()
        return out, dealt

    (few, dealt), (many, none) = run(3), run(500_000)
    assert few == many and dealt > 0 and none == 0
