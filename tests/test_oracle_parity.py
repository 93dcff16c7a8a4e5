"""Every registered query equals its DuckDB oracle on the smallest data set
(the driver repeats this at sf0.01)."""

import pytest

import __spark_entry__ as entry
from recurra.plans.queries import QUERIES
from tests.compare import compare
from tests.conftest import SF_SMALL

SQL = entry.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(SQL)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    r = compare(spark, duck, name, QUERIES[name](spark, SF_SMALL), SQL[name])
    assert r["status"] == "MATCH", r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert "customer_classification" in df.columns
    assert df.count() > 0
