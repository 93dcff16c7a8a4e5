"""Hand-written scenarios the fixture derivation cannot reach."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from recurra.config import Config
from recurra.plans.pipeline import Pipeline
from recurra.sources.calendar import day_calendar
from recurra.sources.tables import Inputs

TXN_SCHEMA = (
    "id string, currentbillingentityid string, DATE timestamp_ntz, periodstart timestamp_ntz, "
    "periodend timestamp_ntz, originalamount double, originalcurrencycode string, objectid string, "
    "objecttypeid string, objectaccesstype string, type string, source string, connectedto string"
)


def ts(s):
    return dt.datetime.fromisoformat(s)


def txn(id_, cust, start, end, amount, type_="Charge", obj="L1", ptype="P0"):
    return (id_, cust, ts(start), ts(start), ts(end), amount, "USD", obj, ptype, "Multi User", type_, "Manual", "X")


def make_inputs(spark, rows, **other):
    given = dict(
        transactions=spark.createDataFrame(rows, TXN_SCHEMA),
        company=spark.createDataFrame(
            [("C1", "acme", "SMB", "n1", "s", "c"), ("C2", "beta", "SMB", None, "s", "c")],
            "id string, name string, classification string, countrycode string, state string, city string",
        ),
        product_dim=spark.createDataFrame([("P0", "Kettle"), ("P9", "Empty")], "objecttypeid string, product string"),
        price_grid=spark.createDataFrame(
            [], "currency_code string, product string, objectaccesstype string, price_th1 double, "
            "price_th2 double, price_th3 double"),
        legacy_licenses=spark.createDataFrame([], "licenseid string"),
        calendar=day_calendar(spark, dt.date(1999, 12, 1), dt.date(2001, 12, 31)),
        region_dim=spark.createDataFrame([("N1", "Nation One")], "country_code string, country string"),
    )
    return Inputs(**(given | other))


@pytest.fixture(scope="module")
def gap_pipeline(spark):
    rows = [
        txn("T1", "C1", "2000-01-10 00:00:00", "2000-04-10 00:00:00", 300.0),  # 1200/yr, Jan-Mar
        txn("T2", "C1", "2000-06-05 00:00:00", "2000-07-05 00:00:00", 100.0),  # 1200/yr, Jun
        txn("T3", "C2", "2000-01-01 00:00:00", "2000-02-01 00:00:00", 50.0, obj="L2"),  # refunded
        txn("R3", "C2", "2000-01-01 00:00:00", "2000-02-01 00:00:00", 50.0, "Refund", obj="L2"),
    ]
    return Pipeline(make_inputs(spark, rows), Config(as_of=dt.date(2001, 1, 1)), products=True)


def test_refund_pair_removes_charge(gap_pipeline):
    p = gap_pipeline
    pairs = [(r.refund_id, r.charge_id) for r in p.refund_sets.clean.collect()]
    assert pairs == [("R3", "T3")]
    ids = {r.ordernumber for r in p.orders.filter(F.col("for_product") == "All").collect()}
    assert ids == {"T1", "T2"}
    refunded = p.refunded_arr().collect()
    assert [(r.ordernumber, str(r.pivot_month), r.refunded_arr_currency) for r in refunded] == [
        ("T3", "2000-02-29", 600.0)
    ]


def test_rollforward_labels(gap_pipeline):
    rf = gap_pipeline.rollforward.filter((F.col("for_product") == "All") & (F.col("customer_id") == "C1"))
    got = {str(r.pivot_month): (r.customer_classification, r.arr_spot_rate_usd) for r in rf.collect()}
    assert got == {
        "2000-01-31": ("New", 1200.0),
        "2000-02-29": ("ForEx", 1200.0),
        "2000-03-31": ("ForEx", 1200.0),
        "2000-04-30": ("Churn", None),
        "2000-05-31": ("-", None),
        "2000-06-30": ("Reactivation", 1200.0),
        "2000-07-31": ("Churn", None),
    }


def test_empty_product_slice_has_spine_rows(gap_pipeline):
    rf = gap_pipeline.rollforward.filter(F.col("for_product") == "Empty").collect()
    assert len(rf) == 25  # every month of the calendar, no customer
    assert {r.customer_id for r in rf} == {None}
    assert {r.customer_classification for r in rf} == {"-"}


def test_arr_final_gap_and_interim_churn(gap_pipeline):
    af = gap_pipeline.arr_final.filter((F.col("for_product") == "All") & (F.col("customer_id") == "C1"))
    got = sorted(
        (str(r.pivot_month), r.ordernumber, r.customer_classification, r.arr_currency, r.churn_arr_currency,
         r.interim_churn_arr_currency, r.new_currency, r.reactivation_currency)
        for r in af.collect()
    )
    assert got == [
        ("2000-01-31", "T1", "New", 1200.0, 0.0, 0.0, 1200.0, 0.0),
        ("2000-02-29", "T1", "ForEx", 1200.0, 0.0, 0.0, 0.0, 0.0),
        ("2000-03-31", "T1", "ForEx", 1200.0, 0.0, 0.0, 0.0, 0.0),
        ("2000-04-30", "T1", "Interim Churn", 0.0, 0.0, -1200.0, 0.0, 0.0),
        ("2000-06-30", "T2", "Reactivation", 1200.0, 0.0, 0.0, 0.0, 1200.0),
        ("2000-07-31", "T2", "Churn", 0.0, -1200.0, 0.0, 0.0, 0.0),
    ]
    countries = {r.country_name for r in af.collect()}
    assert countries == {"Nation One"}


def test_grace_period_clipped_by_next_start(spark):
    rows = [
        txn("A", "C1", "2000-01-10 00:00:00", "2000-02-10 00:00:00", 100.0),
        txn("B", "C1", "2000-02-20 00:00:00", "2000-03-20 00:00:00", 100.0),
        txn("C", "C1", "2000-05-01 00:00:00", "2000-06-01 00:00:00", 100.0),
    ]
    p = Pipeline(make_inputs(spark, rows), Config(grace_days=30, as_of=dt.date(2001, 1, 1)), products=False)
    got = {r.ordernumber: str(r.standardenddate_adjusted) for r in p.orders.collect()}
    assert got == {"A": "2000-02-20", "B": "2000-04-19", "C": "2000-07-01"}


def test_ambiguous_refunds_go_unmatched(spark):
    rows = [
        txn("T1", "C1", "2000-01-10 00:00:00", "2000-02-10 00:00:00", 100.0),
        txn("R1", "C1", "2000-01-10 00:00:00", "2000-02-10 00:00:00", 100.0, "refund"),
        txn("R2", "C1", "2000-01-10 00:00:00", "2000-02-10 00:00:00", 100.0, "REFUND"),
        txn("R9", "C1", "2000-01-10 00:00:00", "2000-02-10 00:00:00", 99.0, "Refund"),  # no charge
        txn("TN", "C1", "2000-01-10 00:00:00", "2000-02-10 00:00:00", 100.0, None),
    ]
    p = Pipeline(make_inputs(spark, rows), Config(as_of=dt.date(2001, 1, 1)), products=False)
    rs = p.refund_sets
    assert sorted((r.charge_id, r.n) for r in rs.dup_charges.collect()) == [("T1", 2)]
    assert rs.clean.count() == 0
    unmatched = sorted((r.refund_id, r.charge_id) for r in rs.unmatched.collect())
    assert unmatched == [("R1", "T1"), ("R2", "T1"), ("R9", None)]
    # the NULL-type row is neither a charge nor a refund, and stays an order
    assert {r.ordernumber for r in p.orders.collect()} == {"T1", "TN"}


ONE_ORDER = [txn("T1", "C1", "2000-01-10 00:00:00", "2000-04-10 00:00:00", 300.0)]  # 1200/yr, Jan-Mar


def churn_rows(p):
    af = p.arr_final.filter((F.col("for_product") == "All") & (F.col("churn_arr_currency") != 0))
    return [(str(r.pivot_month), r.customer_classification, r.churn_arr_currency) for r in af.collect()]


COMPANY = "id string, name string, classification string, countrycode string, state string, city string"


@pytest.mark.parametrize(
    "rows, other",
    [
        (ONE_ORDER, {"product_dim": ([("P0", "Kettle"), ("P0", "Kettle")], "objecttypeid string, product string")}),
        (ONE_ORDER, {"company": ([("C1", "acme", "SMB", "n1", "s", "c"), ("C1", "ACME", "SMB", "n1", "s", "c")], COMPANY)}),
        (ONE_ORDER * 2, {}),
    ],
    ids=["product", "company", "transaction"],
)
def test_one_churn_row_where_rows_repeat_an_order(spark, rows, other):
    """The doubled order pays twice and churns once, with all it paid."""
    given = make_inputs(spark, rows, **{k: spark.createDataFrame(*v) for k, v in other.items()})
    p = Pipeline(given, Config(as_of=dt.date(2001, 1, 1)), products=False)
    assert churn_rows(p) == [("2000-04-30", "Churn", -2400.0)]


@pytest.mark.parametrize("materialize", [True, False])
def test_month_missing_from_the_calendar(spark, materialize):
    cal = day_calendar(spark, dt.date(1999, 12, 1), dt.date(2001, 12, 31)).filter("date_trunc('month', ds) <> '2000-02-01'")
    cfg = Config(as_of=dt.date(2001, 1, 1), materialize=materialize)
    refund = txn("R9", "C1", "2000-01-10 00:00:00", "2000-04-10 00:00:00", 299.0, "Refund")
    p = Pipeline(make_inputs(spark, [*ONE_ORDER, refund], calendar=cal), cfg, products=False)
    months = sorted(str(r.pivot_month) for r in p.arr_monthly.collect())
    assert months == ["2000-01-31", "2000-03-31"]
    rf = {str(r.pivot_month): r.customer_classification for r in p.rollforward.filter("customer_id = 'C1'").collect()}
    assert rf == {"2000-01-31": "New", "2000-03-31": "ForEx", "2000-04-30": "Churn"}
    assert sorted(str(r.pivot_month) for r in p.not_refunded_arr().collect()) == ["2000-01-31", "2000-03-31"]
    # a month without the one before is a gap, as the source counts months
    assert len(p.rollforward.filter("customer_id IS NULL").collect()) == 25 - 1 - 3


def test_legacy_outputs_need_their_rules(spark):
    p = Pipeline(make_inputs(spark, ONE_ORDER), Config(as_of=dt.date(2001, 1, 1)), products=False)
    with pytest.raises(ValueError, match="legacy_products"):
        p.legacy_tracker  # noqa: B018
    with pytest.raises(ValueError, match="legacy_products"):
        p.outputs()


CLASSIFIED = (
    "id string, currentbillingentityid string, DATE timestamp_ntz, transactionarr double, termlength string, "
    "customername string, objecttypeid string, type string, matchingrefund string"
)


def batch_pipeline(spark, **cfg):
    rows = [
        ("T1", "C1", ts("2000-01-31 23:30:00"), 100.0, "MONTHLY", "acme", "P0", "Charge", "R1"),
        ("T2", "C1", ts("2000-05-10 00:00:00"), 50.0, "YEARLY", "acme", "P7", "Charge", None),
        ("R1", "C1", ts("2000-02-01 00:00:00"), 100.0, "MONTHLY", "acme", "P0", "Refund", None),
    ]
    given = make_inputs(spark, ONE_ORDER, classified=spark.createDataFrame(rows, CLASSIFIED))
    given.batch_company = given.company.drop("name")
    return Pipeline(given, Config(as_of=dt.date(2001, 1, 1), batch_product_map={"P0": "Kettle"}, **cfg), products=False)


def test_batch_strict_drops_refunded_charges(spark):
    assert {r.ordernumber for r in batch_pipeline(spark).batch_orders.collect()} == {"T1", "T2"}
    assert {r.ordernumber for r in batch_pipeline(spark, strict=True).batch_orders.collect()} == {"T2"}


def test_batch_source_time_zone(spark):
    day = lambda p: {r.ordernumber: str(r.orderdate) for r in p.batch_orders.collect()}["T1"]
    assert day(batch_pipeline(spark)) == "2000-01-31"
    assert day(batch_pipeline(spark, source_tz="America/New_York")) == "2000-02-01"
