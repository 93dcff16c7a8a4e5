"""The orders are moved once: what follows on a customer reads them as they
lie, and so do copies, customer-months and customer facts."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from recurra.operators import staging
from recurra.plans.pipeline import Pipeline
from recurra.sources import fixtures
from recurra.sources.fixtures import fixture_config, fixture_inputs
from tests.conftest import SF_SMALL
from tests.test_hot_customer import no_broadcast, plan_of  # noqa: F401


def moves(plan, table):
    """For each scan of `table`: whether an exchange lies above it."""
    lines = plan.splitlines()
    depth = [len(re.match(r"[ :|+*\-]*", x).group(0)) for x in lines]
    out = []
    for k in (k for k, x in enumerate(lines) if "FileScan parquet" in x and table in x):
        level, moved = depth[k], False
        for j in range(k - 1, -1, -1):
            if depth[j] < level:
                level, moved = depth[j], moved or "Exchange" in lines[j]
        out.append(moved)
    return out


@pytest.fixture(scope="module")
def pipe(spark):
    return Pipeline(fixture_inputs(spark, SF_SMALL, prepare=False), fixture_config(), products=True)


def test_customer_months_are_not_moved(pipe, no_broadcast):  # noqa: F811
    # the second scan is that of the hot customers' orders
    assert sorted(moves(plan_of(pipe.labelled), "recurra_orders")) == [False, True]


def test_facts_are_not_moved(pipe, no_broadcast):  # noqa: F811
    plan = plan_of(pipe.arr_final)
    assert moves(plan, "recurra_customer_facts") == [False]
    assert not any(moves(plan, "recurra_orders"))


@pytest.mark.parametrize("products", [False, True])
def test_copies_are_numbered_where_they_lie(pipe, no_broadcast, products):  # noqa: F811
    plan = plan_of(staging.lay_orders(staging.in_slices(pipe.staged, products), pipe.hot, None, 4))
    assert plan.index("HashAggregate") < plan.index("Exchange")  # the count of copies is above the first exchange, which is
    assert "REPARTITION_BY_NUM" in plan[plan.index("Exchange") :].splitlines()[0]


def test_batch_orders_are_moved_once(pipe, no_broadcast):  # noqa: F811
    p = Pipeline(pipe.inputs, pipe.cfg)
    assert sorted(moves(plan_of(p.batch_labelled), "recurra_batch_orders")) == [False, True]


def test_rows_repeated_too_often_for_a_task(spark):
    inp = fixture_inputs(spark, SF_SMALL, prepare=False)
    some = F.pmod(F.xxhash64("id"), F.lit(50)) == 0
    inp.transactions = inp.transactions.withColumn("_n", F.explode(F.sequence(F.lit(1), F.when(some, 12).otherwise(1)))).drop("_n")

    def run(most):
        p = Pipeline(inp, fixture_config(hot_orders=most), products=True)
        return p.orders, Counter(map(repr, p.arr_final.collect()))

    (orders, few), (_, many) = run(5), run(500_000)
    assert few == many
    groups = orders.groupBy("for_product", "_h").agg(F.count("*").alias("n"), F.countDistinct("_copy").alias("d"), F.max("_copy").alias("top"), F.countDistinct("_salt").alias("s"))
    assert groups.filter("n <> d OR top <> n - 1").count() == 0
    assert groups.filter("n >= 12 AND s > 1").count() > 0  # dealt copy by copy


def test_only_the_facts_asked_for_are_written(spark, tmp_path):
    folder = f"{tmp_path}/in"
    for t in ("orders", "customer", "nation"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(f"{folder}/{t}.parquet")
    key = (spark.sparkContext.applicationId, folder)
    fixture_inputs(spark, folder, facts=("transactions",))
    assert fixtures._WRITTEN[key] == {"transactions"}
    both = fixture_inputs(spark, folder)
    assert fixtures._WRITTEN[key] == {"transactions", "classified"}
    assert both.classified.count() == both.transactions.count()
