"""O14 with a grace period: the next start is found where the orders lie."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from recurra.operators import staging
from recurra.plans.pipeline import Pipeline
from recurra.sources.fixtures import fixture_config, fixture_inputs
from tests.conftest import SF_SMALL
from tests.test_hot_customer import no_broadcast, plan_of  # noqa: F401


@pytest.fixture(scope="module")
def inputs(spark):
    inp = fixture_inputs(spark, SF_SMALL, prepare=False)
    end = F.expr("CASE WHEN xxhash64(id) % 9 = 0 THEN NULL ELSE periodend END")
    inp.transactions = inp.transactions.withColumn("periodend", end)
    return inp


def key(rows):
    cols = ["for_product", "customer_id", "ordernumber", "standardstartdate", "standardenddate", "standardenddate_adjusted"]
    return sorted(map(repr, rows.select(*cols).collect()))


@pytest.mark.parametrize("most", [500_000, 5])  # 5: most customers' orders are dealt to several parts
def test_ends_are_those_of_a_plain_loop(inputs, most):
    p = Pipeline(inputs, fixture_config(grace_days=30, hot_orders=most), products=True)
    rows = p.orders.collect()
    assert (p.hot.count() > 0) == (most == 5)
    plain = Pipeline(inputs, fixture_config(), products=True).orders
    starts = {}
    for r in plain.select("for_product", "customer_id", "standardstartdate").distinct().collect():
        if r.standardstartdate is not None:
            starts.setdefault((r.for_product, r.customer_id), []).append(r.standardstartdate)
    cut = 0
    assert len(rows) == plain.count()
    for r in rows:
        if r.customer_id is None or r.ordernumber is None or r.standardenddate is None or not (r._cost_u or 0) > 0:
            continue
        most_late = r.standardenddate + dt.timedelta(days=30)
        after = [s for s in starts[r.for_product, r.customer_id] if r.standardstartdate is not None and s > r.standardstartdate]
        want = max(r.standardenddate, min([most_late, *after]))
        cut += want < most_late
        assert r.standardenddate_adjusted == want, r
    assert cut > 10


def test_hot_or_not_the_ends_are_the_same(inputs):
    a, b = (Pipeline(inputs, fixture_config(grace_days=30, hot_orders=most), products=True).orders for most in (500_000, 5))
    assert key(a) == key(b)


@pytest.mark.parametrize("most", [500_000, 5])
def test_orders_are_moved_once(inputs, no_broadcast, most):  # noqa: F811
    p = Pipeline(inputs, fixture_config(hot_orders=most), products=True)
    laid = staging.lay_orders(staging.slice_orders(p.staged, inputs.region_dim), p.hot, None, 4)
    starts = staging.hot_starts(staging.in_slices(p.staged, True), p.hot, 4) if most == 5 else None
    plan = plan_of(staging.stretch_end_dates(laid, 30, starts))
    above = plan[: plan.index("REPARTITION_BY_NUM")]
    assert above.count("Exchange") == 1 and "standardstartdate" in above
    assert "Join [for_product" not in above
