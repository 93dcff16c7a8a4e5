"""Document quality from random-indexing word vectors and a small network.

Tokens are runs of letters (A-Z lower-cased), digits or one other symbol;
words all in capitals share one token, digits another, each ASCII symbol has
its own, and all further words are hashed into the rest of `BUCKETS`, so that
words share a vector only where a corpus has more of them than buckets, or by
chance. Every bucket has a sparse random index vector; its word vector is the
sum of the index vectors of its neighbours (two on either side) over the whole
corpus. Each task adds the index vectors up in integers and sends the buckets
it has met; the table is cut into slices by bucket range, and each slice of all
tasks is summed as a stream.

A document is pooled to the mean and spread of its tokens' vectors. A
two-layer numpy network is fitted on a bounded sample of labelled rows
(`MAX_ROWS`, held-out fold excluded), and its logits are divided by a
temperature fitted on a part of the sample the network has not seen. Only the
text is an input of a score.

Defined cases: a null or empty text has zero pools and gets a score like any
other; repeated rows score alike; of rows that share a labelled id one is
learned from; without usable labels every score is 0.5; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recurra.llm.common import Block, documents, id_and_text, lower_ascii, pack_arrays, small_blocks, table, unpack_arrays, word_hashes
from recurra.llm.toxicity import held_out, labelled_sample, one_per_id

MAX_ROWS = 12_000
BUCKETS = 1 << 17
DIM = 64
HIDDEN = 32
SLICES = 128  # of the table of word vectors, each summed in one task
PIECE = 1 << 15  # tokens worked on at a time
_SPECIAL = 256  # 0: capitals, 1: digits, further: the symbol's byte

_CLASS = np.full(256, 3, np.uint8)  # 0 blank, 1 letter, 2 digit, 3 symbol
_CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_CLASS[48:58] = 2
_CLASS[[32, *range(9, 14)]] = 0


def tokens(b: Block) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every token, and its document."""
    kind = _CLASS[b.buf]
    same = (kind[1:] == kind[:-1]) & ((kind[1:] < 3) | (b.buf[1:] == b.buf[:-1]))
    start = np.concatenate([[0], np.flatnonzero(~same) + 1]) if len(kind) else np.empty(0, np.int64)
    end = np.concatenate([start[1:], [len(kind)]])
    use = kind[start] > 0
    start, end = start[use], end[use]
    what = kind[start]
    low = np.concatenate([[0], np.cumsum((b.buf - np.uint8(97)) < 26)])
    cap = np.concatenate([[0], np.cumsum((b.buf - np.uint8(65)) < 26)])
    shout = (what == 1) & (low[end] == low[start]) & (cap[end] - cap[start] >= 2)
    h = word_hashes(lower_ascii(b.buf), start, end)
    bucket = _SPECIAL + (h % np.uint64(BUCKETS - _SPECIAL)).astype(np.int64)
    bucket[what == 3] = b.buf[start[what == 3]]
    bucket[what == 2] = 1
    bucket[shout] = 0
    return bucket, np.searchsorted(b.starts, start, "right") - 1


@cache
def index_vectors(seed: int = 11, nonzero: int = 8) -> np.ndarray:
    """For every bucket -1 or 1 in one place of each `nonzero`-th of the row, else 0."""
    rng = np.random.default_rng(seed)
    width = DIM // nonzero
    out = np.zeros((BUCKETS, DIM), np.int8)
    at = np.arange(nonzero) * width + rng.integers(width, size=(BUCKETS, nonzero))
    np.put_along_axis(out, at, rng.choice(np.array([-1, 1], np.int8), (BUCKETS, nonzero)), axis=1)
    return out


def near_sums(t: np.ndarray, doc: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, sums of the index vectors of their neighbours), for a piece of
    the tokens at a time."""
    for lo in range(0, len(t), PIECE):
        hi = min(len(t), lo + PIECE)
        a, b = max(0, lo - 2), min(len(t), hi + 2)  # neighbours may lie outside the piece
        index, d = index_vectors()[t[a:b]], doc[a:b]
        near = np.zeros((b - a, DIM), np.int8)
        for step in (1, 2):
            same = (d[step:] == d[:-step])[:, None]
            near[step:] += index[:-step] * same
            near[:-step] += index[step:] * same
        order = np.argsort(t[lo:hi], kind="stable")
        bucket = t[lo:hi][order]
        first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        yield bucket[first], np.add.reduceat(near[lo - a : hi - a][order], first, axis=0, dtype=np.int64)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit word vectors (BUCKETS x DIM) of the whole corpus."""
    width = BUCKETS // SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, met = np.zeros((BUCKETS, DIM), np.int64), np.zeros(BUCKETS, bool)
        for b in small_blocks(batches):
            for bucket, near in near_sums(*tokens(b)):
                total[bucket] += near
                met[bucket] = True
        for k in range(SLICES):
            at = np.flatnonzero(met[k * width : (k + 1) * width])
            if len(at):
                part = total[k * width + at]
                top = np.abs(part).max()
                small = next(t for t in (np.int8, np.int16, np.int32, np.int64) if top <= np.iinfo(t).max)
                yield as_row(k, pack_arrays(at.astype(np.int32), part.astype(small).ravel()))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                at, part = unpack_arrays(x.as_py())
                if k not in total:
                    total[k] = np.zeros((width, DIM), np.int64)
                total[k][at] += part.reshape(-1, DIM)
        for k, c in total.items():
            size = np.sqrt((c.astype(float) ** 2).sum(axis=1, keepdims=True))
            yield as_row(k, (c / np.where(size == 0, 1, size)).astype(np.float32).tobytes())

    def as_row(k: int, x: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([x], pa.binary())], names=["slice", "sums"])

    schema = "slice long, sums binary"
    slices = id_and_text(docs).mapInArrow(count, schema).repartition(SLICES, "slice").mapInArrow(add, schema)
    vectors = np.zeros((BUCKETS, DIM), np.float32)
    for r in slices.collect():  # SLICES rows
        vectors[r["slice"] * width : (r["slice"] + 1) * width] = np.frombuffer(r["sums"], np.float32).reshape(width, DIM)
    return vectors


def pooled(b: Block, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the token vectors of each document."""
    t, doc = tokens(b)
    first = np.searchsorted(doc, np.arange(len(b) + 1)).tolist()
    out = np.zeros((len(b), 2 * DIM), np.float32)
    for d in range(len(b)):
        total, square = np.zeros(DIM), np.zeros(DIM)
        for lo in range(first[d], first[d + 1], PIECE):
            x = vectors[t[lo : min(lo + PIECE, first[d + 1])]]
            total += x.sum(axis=0, dtype=np.float64)
            square += (x * x).sum(axis=0, dtype=np.float64)
        n = max(1, first[d + 1] - first[d])
        out[d, :DIM] = total / n
        out[d, DIM:] = np.sqrt(np.maximum(square / n - (total / n) ** 2, 0))
    return out


class Network:
    """Two layers and a temperature; `score` gives P(label 1)."""

    def __init__(self, mean, scale, w1, b1, w2, b2, temperature):
        self.parts = (mean, scale, w1, b1, w2, b2, temperature)

    def logit(self, x: np.ndarray) -> np.ndarray:
        mean, scale, w1, b1, w2, b2, _ = self.parts
        return np.tanh((x - mean) / scale @ w1 + b1) @ w2 + b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.parts[-1], -500, 500)))


def fit_network(x: np.ndarray, y: np.ndarray, steps: int = 600, batch: int = 512, rate: float = 3e-3, ridge: float = 1e-4, seed: int = 5) -> Network:
    rng = np.random.default_rng(seed)
    x = x.astype(float)
    flat = Network(0.0, 1.0, np.zeros((2 * DIM, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), 0.0, 1.0)
    if len(np.unique(y)) < 2:
        return flat
    order = rng.permutation(len(y))
    kept = max(1, len(y) // 6)  # for the temperature
    cal, fit = order[:kept], order[kept:]
    mean, scale = x[fit].mean(axis=0), x[fit].std(axis=0) + 1e-6
    p = [rng.normal(0, (2 * DIM) ** -0.5, (2 * DIM, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(())]
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    z = (x - mean) / scale
    for t in range(1, steps + 1):
        at = rng.choice(fit, min(batch, len(fit)), replace=False)
        h = np.tanh(z[at] @ p[0] + p[1])
        d = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -500, 500))) - y[at]) / len(at)
        dh = d[:, None] * p[2] * (1 - h**2)
        g = [z[at].T @ dh + ridge * p[0], dh.sum(axis=0), h.T @ d + ridge * p[2], d.sum()]
        for k in range(4):
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
            p[k] = p[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    net = Network(mean, scale, *p, 1.0)
    logit, target = net.logit(x[cal]), y[cal]

    def loss(temperature: float) -> float:
        s = logit / temperature
        return float((np.logaddexp(0, s) - target * s).mean())

    best = min(np.exp(np.linspace(np.log(0.25), np.log(8), 121)), key=loss)
    return Network(mean, scale, *p, float(best))


def fit_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> tuple[np.ndarray, Network]:
    vectors = word_vectors(docs)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column(2)
            at = 0
            for b in small_blocks([batch]):
                x = [r.tobytes() for r in pooled(b, shared.value)]
                yield pa.RecordBatch.from_arrays([b.doc_ids(), pa.array(x, pa.binary()), y.slice(at, len(b))], names=["doc_id", "x", "y"])
                at += len(b)

    sample = labelled_sample(docs, labels, "quality", max_rows).select("doc_id", "text", "y")
    rows = sorted(one_per_id(sample.mapInArrow(features, "doc_id long, x binary, y int"), "x").collect())
    x = np.array([np.frombuffer(r["x"], np.float32) for r in rows], np.float32).reshape(len(rows), 2 * DIM)
    return vectors, fit_network(x, np.array([r["y"] for r in rows], np.int64))


def score_quality(docs: DataFrame, vectors: np.ndarray, net: Network) -> DataFrame:
    state = docs.sparkSession.sparkContext.broadcast((vectors, net.parts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, parts = state.value
        fitted = Network(*parts)
        for b in small_blocks(batches):
            s = fitted.score(pooled(b, vectors))
            yield pa.RecordBatch.from_arrays([b.doc_ids(), pa.array(s, pa.float64())], names=["doc_id", "score"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, score double")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored: doc_id, held_out, score, predicted."""
    docs = documents(spark, sf_dir)
    vectors, net = fit_quality(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, vectors, net).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
