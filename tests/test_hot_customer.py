"""A customer holding a third of all transactions (the skew case the design
must survive): the same answer as the SQL oracle on the same data, its orders
in several parts of the join, and no order moved for that join."""

import re

import pytest
from pyspark.sql import functions as F

from recurra.operators import staging
from recurra.plans.oracle import oracle_sql
from recurra.plans.pipeline import Pipeline
from recurra.sources.fixtures import fixture_config, fixture_inputs
from tests.compare import compare
from tests.conftest import SF_SMALL

HOT = "C_HOT"
MOST = 100


def plan_of(df):
    return df.select("*")._jdf.queryExecution().executedPlan().toString()  # planned anew


@pytest.fixture(scope="module")
def hot(spark):
    inp = fixture_inputs(spark, SF_SMALL, prepare=False)
    # every third order's customer becomes one big reseller
    third = F.substring("id", 2, 20).cast("long") % 3 == 0
    inp.transactions = inp.transactions.withColumn(
        "currentbillingentityid", F.when(third, F.lit(HOT)).otherwise(F.col("currentbillingentityid"))
    )
    return Pipeline(inp, fixture_config(hot_orders=MOST), products=True)


@pytest.fixture()
def no_broadcast(spark):
    limits = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for c in limits:
        spark.conf.set(c, "-1")
    yield
    for c in limits:
        spark.conf.unset(c)


def test_hot_customer_matches_oracle(spark, duck, hot):
    got = hot.arr_final
    assert got.filter(F.col("customer_id") == HOT).count() > got.count() / 5

    sql = oracle_sql()["product_slices"].replace(
        "'C' || CAST(ck AS VARCHAR) AS currentbillingentityid",
        f"CASE WHEN k % 3 = 0 THEN '{HOT}' ELSE 'C' || CAST(ck AS VARCHAR) END AS currentbillingentityid",
    )
    assert HOT in sql
    r = compare(spark, duck, "hot_customer", got, sql)
    assert r["status"] == "MATCH", r


def test_hot_customer_is_split_where_it_lies(spark, hot, no_broadcast):
    orders = hot.orders.withColumn("_bucket", F.pmod(F.hash(*staging.MEET), F.lit(8)))  # as the table is bucketed
    mine = orders.filter((F.col("customer_id") == HOT) & (F.col("for_product") == "All"))
    parts = mine.groupBy("_salt").agg(F.count("*").alias("n"), F.countDistinct("_bucket").alias("buckets")).collect()
    assert len(parts) >= 4 and max(r.n for r in parts) <= 2 * MOST and all(r.buckets == 1 for r in parts)
    assert mine.select("_bucket").distinct().count() >= 3
    others = orders.join(hot.hot, ["for_product", "customer_id"], "left_anti")
    assert others.filter("customer_id IS NOT NULL AND _salt <> 0").count() == 0
    # the join reads the orders as they lie: the only exchanges are on the facts' side
    orders_side = re.search(r"FileScan parquet [^\n]*recurra_orders[^\n]*", plan_of(hot.arr_final)).group(0)
    assert "Bucketed: true" in orders_side and re.search(r"SelectedBucketsCount: (\d+) out of \1\b", orders_side)


def test_orders_are_not_exchanged(spark, hot, no_broadcast):
    plan = plan_of(hot.arr_final)
    lines = plan.splitlines()
    depth = [len(re.match(r"[ :|+*\-]*", x).group(0)) for x in lines]
    scans = [k for k, x in enumerate(lines) if "FileScan parquet" in x and "recurra_orders" in x]
    assert scans and "SortMergeJoin [for_product" in plan
    for k in scans:
        level = depth[k]
        for j in range(k - 1, -1, -1):  # up through the ancestors of the scan
            if depth[j] < level:
                level = depth[j]
                assert "Exchange" not in lines[j], lines[j]


def test_salts_of_facts_meet_those_of_orders(spark):
    hot = spark.createDataFrame([("All", "a", 3), ("All", None, 2)], "for_product string, customer_id string, _salts long")
    orders = spark.createDataFrame(
        [("All", c, f"o{k}", None if k % 2 else "X", k, 0) for c in ("a", "b", None) for k in range(200)],
        "for_product string, customer_id string, ordernumber string, company string, _h long, _copy long",
    )
    dealt = staging.deal_orders(orders, hot)
    assert {(r.customer_id, r._salt) for r in dealt.collect()} == {("a", 0), ("a", 1), ("a", 2), ("b", 0), (None, 0), (None, 1)}
    facts = staging.copy_facts(orders.select("for_product", "customer_id", "company").distinct(), hot)
    joined = dealt.join(facts.drop("company"), staging.MEET)
    assert joined.count() == 400 and joined.filter("customer_id IS NULL").count() == 0
