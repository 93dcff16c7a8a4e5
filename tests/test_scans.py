"""How often the transactions, the pairs and the staged orders are read."""

from recurra.operators import legacy, refunds, staging
from recurra.plans.pipeline import Pipeline
from recurra.sources.fixtures import fixture_config, fixture_inputs
from tests.conftest import SF_SMALL


def scans(df, path):
    plan = df.select("*")._jdf.queryExecution().executedPlan().toString()
    return sum("FileScan parquet" in x and path in x for x in plan.splitlines())


def test_pairs_are_read_twice(spark, tmp_path):
    refunds.refund_match(fixture_inputs(spark, SF_SMALL, prepare=False).transactions).write.parquet(f"{tmp_path}/pairs")
    pairs = spark.read.parquet(f"{tmp_path}/pairs")
    ends = refunds.ambiguous_ends(pairs)
    assert scans(ends, "/pairs") == 1
    ends.write.parquet(f"{tmp_path}/ends")
    ends = spark.read.parquet(f"{tmp_path}/ends")
    flagged = refunds.flag_pairs(pairs, refunds.dup_refunds(ends), refunds.dup_charges(ends))
    assert scans(flagged, "/pairs") == 1
    flagged.write.parquet(f"{tmp_path}/flagged")
    flagged = spark.read.parquet(f"{tmp_path}/flagged")
    assert scans(refunds.clean_refund_map(flagged), "/pairs") == 0 and scans(refunds.clean_refund_map(flagged), "/flagged") == 1


def test_transactions_are_read_twice_for_the_legacy_outputs(spark, tmp_path):
    inp = fixture_inputs(spark, SF_SMALL, prepare=False)
    inp.transactions.write.parquet(f"{tmp_path}/txn")
    inp.transactions = spark.read.parquet(f"{tmp_path}/txn")
    p = Pipeline(inp, fixture_config())
    assert scans(legacy.licence_facts(inp.transactions), "/txn") == 1
    assert scans(p.license_summary, "/txn") == 0
    assert scans(p.churn_for_legacy(), "/txn") == 1
    p.drop_stages()


def test_staged_orders_are_read_once_for_all_slices(spark, tmp_path):
    p = Pipeline(fixture_inputs(spark, SF_SMALL, prepare=False), fixture_config())
    p.staged.write.parquet(f"{tmp_path}/staged")
    p.drop_stages()
    staged = spark.read.parquet(f"{tmp_path}/staged")
    assert scans(staging.in_slices(staged, True), "/staged") == 1
    union = staging.orders_all(staged).unionByName(staging.orders_by_product(staged))
    assert staging.in_slices(staged, True).exceptAll(union).count() == 0
    assert union.exceptAll(staging.in_slices(staged, True)).count() == 0
