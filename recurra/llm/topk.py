"""Exact top-k inner products by aggregation without random access.

Vectors become integers, floor(256 x). Rows are packed into blocks; each
(query block, candidate block) pair is one row of an equi-join, so work and
memory per task are bounded and the query set meets all rows in blocks. Both
sides of that join are shuffled: a block stands in it once for every block of
the other side, which Spark does not see when it guesses which side is small
enough to be broadcast. In a pair, every dimension is a list of the candidates
sorted by value, read from the end that suits the sign of the query's
component. Lists are read sequentially, deeper by steps; each step gives every
candidate a lower and an upper bound (what was read, plus the worst or the last
read value for the dimensions not read). A query stops when few candidates'
upper bounds reach the k-th best lower bound; those candidates' scores are then
resolved, and all others are outsiders that cannot qualify. The best k of all
blocks are merged by a window over at most k rows a block.

Defined cases: vectors that are null or hold a null or non-finite component,
and rows without an id, take no part; a query meets the vectors of its own
length only; a row's own is that row alone, so rows that repeat its id or its
vector are candidates, and each of several rows with a query's id is a query
with results of its own (equal rows are compared once and counted); ties go to
the smaller id; an empty table gives no rows; other columns are ignored. Scores
must fit a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recurra.llm.common import rows_of, sums, table

BLOCK_ROWS = 2048
#: Candidate blocks grow up to so many times BLOCK_ROWS once there are MANY of
#: them, and query blocks have so many rows: a block is sent once for every
#: block of the other side. Scores of a pair that are held at a time.
WIDE, MANY, CELLS = 4, 64, 1 << 22


def narrow(x: np.ndarray) -> np.ndarray:
    """`x` in the narrowest integers that hold it."""
    fits = (t for t in (np.int8, np.int16, np.int32) if np.iinfo(t).min <= x.min(initial=0) and x.max(initial=0) <= np.iinfo(t).max)
    return x.astype(next(fits, np.int64))


def wide(blob: bytes, rows: int, dim: int) -> np.ndarray:
    """What `narrow` was given: `rows` of `dim`."""
    kind = f"i{len(blob) // (rows * dim)}" if rows * dim else np.int64
    return np.frombuffer(blob, kind).reshape(rows, dim).astype(np.int64)


def _pack_vectors(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    x = narrow(np.array(table["x"].combine_chunks().flatten(), np.int64))
    ids, copies = np.array(table["vec_id"], np.int64), np.array(table["copies"], np.int64)
    blobs = {"ids": [ids.tobytes()], "copies": [copies.tobytes()], "x": [x.tobytes()]}
    return pa.table({"block": [key[0].as_py()], "dim": [key[1].as_py()]} | blobs)


def as_blocks(vectors: DataFrame, rows: int, n: int) -> DataFrame:
    """(vec_id, x, copies) in blocks of about `rows` rows, by a hash of both."""
    blocks = max(1, -(-n // rows))
    keyed = vectors.select(
        "vec_id", "x", "copies", F.size("x").cast("long").alias("dim"), F.pmod(F.xxhash64("vec_id", "x"), F.lit(blocks)).alias("block")
    )
    return keyed.groupBy("block", "dim").applyInArrow(_pack_vectors, "block long, dim long, ids binary, copies binary, x binary")


def _kind(q: np.ndarray, x: np.ndarray):
    """The fastest type in which every sum is exact."""
    bound = 2 * q.shape[1] * int(np.abs(q).max(initial=0)) * int(np.abs(x).max(initial=0))
    return np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64


def own_rows(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray) -> np.ndarray:
    """For each query the candidate that is equal to it, or -1."""
    out = np.full(len(q_ids), -1)
    for rows in _few(len(q_ids), len(ids)):
        i, j = np.nonzero(q_ids[rows, None] == ids[None, :])
        i = rows[i]
        same = (q[i] == x[j]).all(axis=1)
        out[i[same]] = j[same]
    return out


def _few(queries: int, n: int) -> list[np.ndarray]:
    """The queries, as many at a time as have CELLS scores."""
    step = max(1, CELLS // max(1, n))
    return [np.arange(lo, min(queries, lo + step)) for lo in range(0, queries, step)]


def best_of_pair(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int, copies: np.ndarray | None = None) -> tuple:
    """Query rows, candidate rows and scores of each query's k best. A query's
    equal is a candidate where it has `copies`."""
    n, d = x.shape
    own_at = own_rows(q_ids, q, ids, x)
    if copies is not None and len(own_at):
        own_at = np.where((own_at >= 0) & (copies[own_at] > 1), -1, own_at)
    kind = _kind(q, x)
    order = np.argsort(x, axis=0, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.broadcast_to(np.arange(n)[:, None], (n, d)), axis=0)
    lists = np.take_along_axis(x, order, axis=0).astype(kind)
    x = x.astype(kind)
    up, down = np.maximum(q, 0).astype(kind), np.minimum(q, 0).astype(kind)
    out: list[tuple[int, np.ndarray, np.ndarray]] = []
    for active in _few(len(q), n):
        out += _read_lists(active, q, up, down, ids, x, place, lists, own_at, k)
    return out


def _read_lists(
    active: np.ndarray, q: np.ndarray, up: np.ndarray, down: np.ndarray, ids: np.ndarray, x: np.ndarray, place: np.ndarray, lists: np.ndarray,
    own_at: np.ndarray, k: int,
) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """`best_of_pair` of the `active` queries. `up`, `down`: the positive and the
    negative part of the queries; `lists`: each dimension sorted, `place`: where
    the candidates stand in it."""
    n, kind = len(x), x.dtype.type
    low = np.iinfo(np.int64).min if kind is np.int64 else -np.inf
    out: list[tuple[int, np.ndarray, np.ndarray]] = []
    depth = min(n, max(64, n // 8))
    while len(active) and n:
        top, bottom = place >= n - depth, place < depth
        a, b = up[active], down[active]
        last_top, last_bottom = lists[n - depth], lists[depth - 1]
        upper = a @ (top * (x - last_top)).T + b @ (bottom * (x - last_bottom)).T
        upper += (a @ last_top + b @ last_bottom)[:, None]
        lower = a @ (top * (x - lists[0])).T + b @ (bottom * (x - lists[-1])).T
        lower += (a @ lists[0] + b @ lists[-1])[:, None]
        own = own_at[active][:, None] == np.arange(n)[None, :]
        upper[own] = lower[own] = low
        bar = np.partition(lower, n - k, axis=1)[:, n - k] if n > k else np.full(len(active), low)
        open_ = (upper >= bar[:, None]) & ~own
        done = (open_.sum(axis=1) <= max(8 * k, n // 16)) | (depth == n)
        for r in np.flatnonzero(done):
            left = np.flatnonzero(open_[r])
            i = active[r]
            score = (x[left].astype(np.int64) * q[i].astype(np.int64)).sum(axis=1)
            best = np.lexsort((ids[left], -score))[:k]
            out.append((i, left[best], score[best]))
        active = active[~done]
        depth = min(n, 2 * depth)
    return out


def top_k(vectors: DataFrame, is_query, k: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """`vectors`: vec_id, x (array<bigint>). query_id, rank, vec_id, score."""
    vectors = vectors.groupBy("vec_id", "x").agg(F.count("*").alias("copies"))
    queries = vectors.filter(is_query)
    size = sums(vectors, n=F.count("*"), q=F.count(F.when(is_query, 1)))
    of_c, of_q = min(WIDE * block_rows, max(block_rows, size["n"] // MANY)), WIDE * block_rows
    c = as_blocks(vectors, of_c, size["n"])
    q = as_blocks(queries, of_q, size["q"])
    n_c, n_q = max(1, -(-size["n"] // of_c)), max(1, -(-size["q"] // of_q))
    every = lambda m: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long")))
    queries = q.select(
        F.col("block").alias("qb"), "dim", F.col("ids").alias("q_ids"), F.col("copies").alias("q_copies"), F.col("x").alias("q_x"), every(n_c).alias("cb")
    )
    candidates = c.select(F.col("block").alias("cb"), "dim", "ids", "copies", "x", every(n_q).alias("qb"))
    pairs = queries.hint("merge").join(candidates, ["qb", "cb", "dim"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in rows_of(batches):
            d = r["dim"]
            q_ids, ids, q_copies, copies = (np.frombuffer(r[c], np.int64) for c in ("q_ids", "ids", "q_copies", "copies"))
            qx, cx = wide(r["q_x"], len(q_ids), d), wide(r["x"], len(ids), d)
            got = best_of_pair(q_ids, qx, ids, cx, k, copies)
            own = own_rows(q_ids, qx, ids, cx)
            flat = [(i, j, s) for i, left, score in got for j, s in zip(left, score)]
            cols = {
                "query_id": [int(q_ids[i]) for i, _, _ in flat],
                "q": [f"{r['qb']}-{d}-{i}" for i, _, _ in flat],
                "queries": [int(q_copies[i]) for i, _, _ in flat],
                "vec_id": [int(ids[j]) for _, j, _ in flat],
                "n": [int(copies[j]) - int(own[i] == j) for i, j, _ in flat],
                "score": [int(s) for _, _, s in flat],
            }
            yield pa.RecordBatch.from_pydict({c: pa.array(v, pa.string() if c == "q" else pa.int64()) for c, v in cols.items()})

    found = pairs.mapInArrow(run, "query_id long, q string, queries long, vec_id long, n long, score long")
    # at most k distinct candidates of a block for a query; equal ones take as many ranks as they are
    w = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id").rowsBetween(Window.unboundedPreceding, 0)
    found = found.withColumn("before", F.sum("n").over(w) - F.col("n")).filter(F.col("before") < k)
    ranks = F.sequence(F.col("before") + 1, F.least(F.col("before") + F.col("n"), F.lit(k)))
    found = found.withColumn("rank", F.explode(ranks)).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "queries")))
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def integer_vectors(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    e = F.col("embedding")
    inf = F.lit(float("inf"))
    good = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < inf))
    return embeddings.filter(F.col("vec_id").isNotNull() & e.isNotNull() & good & (F.size(e) > 0)).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(e, lambda v: F.floor(F.lit(scale) * v.cast("double")).cast("long")).alias("x"),
    )


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best of all vectors for every query: query_id, rank, vec_id, score."""
    vectors = integer_vectors(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, F.col("vec_id") % 50 == 0, 5)


OP3_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS c
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.c, c.c) AS BIGINT) AS score
  FROM v q, v c WHERE q.vec_id % 50 = 0 AND c.r <> q.r
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 5
"""
