"""Queries that SQL can express, against DuckDB."""

import pytest

from recurra.llm.queries import ORACLE_SQL, QUERIES
from tests.compare import compare


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, duck, name):
    got = compare(spark, duck, name, QUERIES[name](spark, "/root/testdata/sf0.001"), ORACLE_SQL[name])
    assert got["status"] == "MATCH", got
