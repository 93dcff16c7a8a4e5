"""A row is known by its content: results do not depend on how the rows are
partitioned or on stage tables, and repeated rows are told apart."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from recurra.operators.staging import content_hash, mark_copies
from recurra.plans.pipeline import Pipeline
from recurra.sources.fixtures import fixture_config, fixture_inputs
from tests.conftest import SF_SMALL


def rows(df):
    return Counter(map(repr, df.collect()))


@pytest.mark.parametrize("chunk", [1 << 20, 7])
def test_copies_are_numbered(spark, chunk):
    given = [("a", 1, None), ("a", 1, None), ("b", None, 1), ("b", 1, None), ("c", 2, 2)] + [("hot", None, None)] * 100
    df = spark.createDataFrame(given, "x string, y int, z int").repartition(6)
    df = df.withColumn("_h", content_hash(df.columns))
    got = mark_copies(df, chunk).collect()
    assert Counter((r.x, r.y, r.z) for r in got) == Counter(given)
    copies = {}
    for r in got:
        copies.setdefault((r.x, r.y, r.z), []).append(r._copy)
    assert all(sorted(c) == list(range(len(c))) for c in copies.values())
    hashes = {(r.x, r.y, r.z): r._h for r in got}
    assert len(set(hashes.values())) == len(hashes)  # a NULL in another column is another row


def test_same_hash_is_not_the_same_row(spark):
    df = spark.createDataFrame([("a", 5), ("b", 5), ("b", 5)], "x string, _h long")
    assert sorted((r.x, r._copy) for r in mark_copies(df).collect()) == [("a", 0), ("b", 0), ("b", 1)]
    assert mark_copies(df.limit(0)).count() == 0


def spread_copies(df, parts):
    """`df` with an exact copy of every ninth row, so that repeated rows tie
    everywhere, partitioned otherwise."""
    df = df.unionByName(df.filter(F.pmod(F.xxhash64("id"), F.lit(9)) == 0))
    return df.repartition(parts, "type") if parts else df


def test_slices_do_not_depend_on_partitions(spark):
    def final(parts):
        inp = fixture_inputs(spark, SF_SMALL, prepare=False)
        inp.transactions = spread_copies(inp.transactions, parts)
        return Pipeline(inp, fixture_config(), products=True).arr_final

    assert rows(final(3)) == rows(final(None))


def test_no_stage_table_is_needed_for_it(spark):
    """The batch generation, whose plan is short enough to run whole."""

    def final(parts, cuts):
        inp = fixture_inputs(spark, SF_SMALL, prepare=False)
        inp.classified = spread_copies(inp.classified, parts)
        return Pipeline(inp, fixture_config(materialize=cuts), products=False).batch_arr_final()

    assert rows(final(13, False)) == rows(final(None, True))
