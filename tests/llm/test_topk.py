import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from recurra.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, x string, block long"


def table(spark, rows):
    return spark.createDataFrame([(i, e, 0, "x", 7) for i, e in rows], SCHEMA).repartition(4)


def brute(rows, k):
    def fine(e):
        return e and all(v is not None and math.isfinite(v) for v in e)

    v = [(i, tuple(math.floor(256 * float(np.float32(c))) for c in e)) for i, e in rows if i is not None and fine(e)]
    out = []
    for at, (q, a) in enumerate(v):
        if q % 50 == 0:
            s = sorted((-sum(x * y for x, y in zip(a, b)), i) for j, (i, b) in enumerate(v) if j != at and len(a) == len(b))[:k]
            out += [(q, r + 1, i, -n) for r, (n, i) in enumerate(s)]
    return sorted(out)


@pytest.mark.parametrize("block_rows", [64, 2048])
def test_top_k(spark, block_rows):
    rng = np.random.default_rng(4)
    e = rng.normal(0, 0.3, (400, 12))
    e[100:180] = e[50]  # ties
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(e)]
    rows += [(1000, None), (1050, [None] * 12), (1100, [float("nan")] * 12), (1150, [float("inf")] * 12), (None, rows[0][1]), (1200, [1.0, 2.0])]
    rows += [rows[3], rows[50], rows[100], rows[150], rows[150], rows[150], (100, rows[7][1]), (1250, []), (1300, [1e6] * 12), (1301, [1.5e6] * 12), (1350, [0.0] * 12)]
    vectors = topk.integer_vectors(table(spark, rows))
    got = topk.top_k(vectors, F.col("vec_id") % 50 == 0, 5, block_rows)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 5)


def test_blocks_are_not_broadcast(spark):
    """Queries that are few still stand in the join once for every candidate block."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(0, 0.3, (900, 8)))]
    got = topk.top_k(topk.integer_vectors(table(spark, rows)), F.col("vec_id") % 50 == 0, 5, 16)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 5)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_blocks_hold_what_they_were_given():
    for least, most in ((0, 0), (-128, 127), (0, 128), (-(2**15), 2**15 - 1), (-(2**15) - 1, 0), (0, 2**31), (-(2**63), 2**63 - 1)):
        x = np.array([[least, most]], np.int64)
        assert (topk.wide(topk.narrow(x).tobytes(), 1, 2) == x).all()


def test_queries_in_parts(monkeypatch):
    rng = np.random.default_rng(6)
    x = rng.integers(-9, 9, (300, 4))
    best = lambda: {i: sorted(zip(-s, at)) for i, at, s in topk.best_of_pair(np.arange(300), x, np.arange(300), x, 5)}
    whole = best()
    monkeypatch.setattr(topk, "CELLS", 1000)
    assert len(whole) == 300 and best() == whole


def test_empty(spark):
    assert topk.top_k(topk.integer_vectors(table(spark, [])), F.col("vec_id") % 50 == 0, 5).count() == 0


def test_repeated_rows_in_sql(spark, tmp_path):
    rows = [(50, [1.0, 2.0]), (50, [1.0, 2.0]), (1, [3.0, 1.0]), (1, [3.0, 1.0]), (2, [0.5, 0.25]), (50, [4.0, 0.0]), (100, [1.0, 1.0])]
    for k in (3, len(rows)):
        path = f"{tmp_path}/{k}"
        table(spark, rows[:k]).write.parquet(f"{path}/embeddings.parquet")
        con = duckdb.connect()
        con.execute(f"create view embeddings as select * from '{path}/embeddings.parquet/*.parquet'")
        got = sorted(tuple(r) for r in topk.op3_topk(spark, path).collect())
        assert got == sorted(con.execute(topk.OP3_SQL).fetchall()) == brute(rows[:k], 5)
