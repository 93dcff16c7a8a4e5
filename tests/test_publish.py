"""Reading inputs, publishing a run, and leaving nothing behind."""

import datetime as dt
import os

import pytest

from recurra.config import Config, PriceRules
from recurra.plans.pipeline import Pipeline
from recurra.session import ensure_checkpoint_dir
from recurra.sources.sinks import current_run
from recurra.sources.tables import read_inputs
from tests.test_scenarios import CLASSIFIED, TXN_SCHEMA, make_inputs, ts, txn

ROWS = [txn("T1", "C1", "2000-01-10 23:30:00", "2000-04-10 23:30:00", 300.0)]
CONFIG = Config(
    as_of=dt.date(2001, 1, 1), price_rules=PriceRules(legacy_products=("Kettle",)), batch_product_map={"P0": "Kettle"}
)


def store(spark, base, batch):
    """The inputs as tables, with instants (not wall-clock times) of UTC."""
    given = make_inputs(spark, ROWS)
    instant = TXN_SCHEMA.replace("timestamp_ntz", "timestamp")
    utc = [tuple(v.replace(tzinfo=dt.timezone.utc) if isinstance(v, dt.datetime) else v for v in r) for r in ROWS]
    spark.createDataFrame(utc, instant).write.parquet(f"{base}/transactions_raw")
    for name, df in (
        ("company_raw", given.company), ("product_dim", given.product_dim), ("price_grid", given.price_grid),
        ("legacy_licenses", given.legacy_licenses), ("calendar", given.calendar), ("region_dim", given.region_dim),
    ):
        df.write.parquet(f"{base}/{name}")
    if batch:
        spark.createDataFrame([("B1", "C7", ts("2000-01-31 00:00:00"), 10.0, "MONTHLY", "x", "P0", "Charge", None)], CLASSIFIED).write.parquet(
            f"{base}/classified_transactions"
        )
        company = [("C7", "SMB", "n1", "s", "only here")]
        spark.createDataFrame(company, "id string, classification string, countrycode string, state string, city string").write.parquet(f"{base}/company")


@pytest.fixture()
def new_york(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("batch", [False, True])
def test_round_trip(spark, tmp_path, new_york, batch):
    base, out = f"{tmp_path}/in", f"{tmp_path}/out"
    store(spark, base, batch)
    given = read_inputs(spark, base)
    assert given.transactions.first().periodstart == dt.datetime(2000, 1, 10, 23, 30)
    assert (given.classified is None) is not batch
    stages = lambda: {f for f in os.listdir(ensure_checkpoint_dir(spark).removeprefix("file:")) if f.startswith("recurra-")}
    before = stages()
    run = Pipeline(given, CONFIG).publish(out)
    assert stages() == before
    assert current_run(spark, out) == run
    months = spark.read.parquet(f"{run}/arr_final").filter("for_product = 'All'").collect()
    assert sorted(str(r.pivot_month) for r in months) == ["2000-01-31", "2000-02-29", "2000-03-31", "2000-04-30"]
    assert os.path.isdir(f"{run}/batch_arr_final") is batch
    if batch:
        assert {r.city for r in spark.read.parquet(f"{run}/batch_arr_final").collect()} == {"ONLY HERE"}
    again = Pipeline(read_inputs(spark, base), CONFIG).publish(out)
    assert again != run and current_run(spark, out) == again and os.path.isdir(run)


def test_unreadable_input_is_an_error(spark, tmp_path):
    base = f"{tmp_path}/in"
    store(spark, base, False)
    os.makedirs(f"{base}/classified_transactions")
    with open(f"{base}/classified_transactions/part-0.parquet", "w") as f:
        f.write("no table")
    with pytest.raises(Exception, match="(?i)parquet|footer|schema"):
        read_inputs(spark, base)


def test_batch_outputs_need_a_product_map(spark, tmp_path):
    store(spark, f"{tmp_path}/in", True)
    cfg = Config(as_of=CONFIG.as_of, price_rules=CONFIG.price_rules)
    with pytest.raises(ValueError, match="batch_product_map"):
        Pipeline(read_inputs(spark, f"{tmp_path}/in"), cfg).outputs()
