"""Toxicity grades by cumulative-link ordinal regression on sparse features.

Features are hashed words (runs of ASCII letters, digits and non-ASCII bytes,
A-Z lower-cased) and their beginnings of 4 and 6 bytes; each has four levels,
true where it occurs at least 1, 2, 4 or 8 times. A bounded sample of labelled
documents (`MAX_ROWS`, by a hash of the id; equal feature sets count once) is
reduced to its features on the executors; the driver keeps those whose
presence differs clearly between labels and fits one weight vector shared by
all ordered thresholds: P(grade > k) = sigmoid(w x - theta_k). Grades are 0 for
label 0; label 1 is graded 1 to 3 by how many of the telling features the
document has, cut at the sample's thirds. Every whole document is then scored
in one narrow pass: expected severity = sum over k of P(grade > k).

Rows whose crc32(doc_id as text) mod 3 is 1 are held out of fitting.

Defined cases: a null or empty text has no features and gets the base
probability; repeated rows are scored alike; of rows that share a labelled id
one is learned from; null labels and labels of no
document are not used; with labels of one kind only, the weights are zero; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recurra.llm.common import Block, documents, filter_documents, id_and_text, lower_ascii, pack_arrays, small_blocks, table, unpack_arrays, word_hashes

MAX_ROWS = 8_000
BITS = 18
LEVELS = (1, 2, 4, 8)
BEGINNINGS = (4, 6)
GRADES = 3
LEAST_Z = 5.0
SCHEMA = "doc_id long, severity double, p_toxic double, grade int"

_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def features(b: Block, kept: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature) of a block, ordered by document; with `kept`, a mask
    over buckets, only features of those."""
    buf = lower_ascii(b.buf)
    edge = np.diff(np.concatenate([[False], _WORD_BYTE[buf], [False]]).view(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    doc = np.searchsorted(b.starts, start, "right") - 1
    parts = [(word_hashes(buf, start, end), doc)]
    for n in BEGINNINGS:
        long = end - start > n
        parts.append((word_hashes(buf, start[long], start[long] + n), doc[long]))
    found = []
    for h, d in parts:
        bucket = (h >> np.uint64(64 - BITS)).astype(np.int64)
        if kept is not None:
            use = kept[bucket]
            bucket, d = bucket[use], d[use]
        found.append((d << BITS) | bucket)
    both, n = np.unique(np.concatenate(found), return_counts=True)
    out = [both[n >= least] * len(LEVELS) + k for k, least in enumerate(LEVELS)]
    out = np.sort(np.concatenate(out))
    width = len(LEVELS) << BITS
    return out // width, out % width


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """(doc_id, text, y) of at most `most` labelled rows outside the held-out
    fold. The chosen labels are at most `most` small rows, so they are
    broadcast and the documents are not shuffled."""
    doc_id = F.col("doc_id").cast("long")
    chosen = (
        labels.select(doc_id.alias("doc_id"), F.col(label).cast("int").alias("y"))
        .filter(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    return id_and_text(docs).join(F.broadcast(chosen), "doc_id")


def one_per_id(sample: DataFrame, features: str) -> DataFrame:
    """One row of a sample for each id, the one of the smallest features, so
    that what reaches the driver is bounded however many rows share an id."""
    return sample.groupBy("doc_id").agg(F.min(features).alias(features), F.first("y").alias("y"))


class OrdinalModel:
    def __init__(self, weight: np.ndarray, theta: np.ndarray):
        self.weight, self.theta = weight, theta

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for every score and threshold."""
        return 1 / (1 + np.exp(np.clip(self.theta[None, :] - score[:, None], -500, 500)))


def fit_ordinal(rows: list[np.ndarray], y: np.ndarray, steps: int = 400, rate: float = 0.1, ridge: float = 3e-5) -> OrdinalModel:
    """`rows`: the features of each document; `y`: its label, 0 or 1."""
    size = len(LEVELS) << BITS
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    feat = np.concatenate([np.empty(0, np.int64), *rows])
    n1, n0 = max(1, int((y == 1).sum())), max(1, int((y == 0).sum()))
    c1 = np.bincount(feat[y[doc] == 1], minlength=size) if len(feat) else np.zeros(size)
    c0 = np.bincount(feat[y[doc] == 0], minlength=size) if len(feat) else np.zeros(size)
    odds = np.log((c1 + 0.5) / (n1 - c1 + 0.5)) - np.log((c0 + 0.5) / (n0 - c0 + 0.5))
    error = np.sqrt(1 / (c1 + 0.5) + 1 / (n1 - c1 + 0.5) + 1 / (c0 + 0.5) + 1 / (n0 - c0 + 0.5))
    kept = np.flatnonzero((np.abs(odds / error) >= LEAST_Z) & (c1 + c0 >= 8))
    theta0 = float(np.log(n0 / n1)) if (y == 1).any() else 20.0
    weight = np.zeros(size, np.float64)
    if not len(kept) or not (y == 1).any() or not (y == 0).any():
        return OrdinalModel(weight, theta0 + np.arange(GRADES, dtype=float))
    column = np.full(size, -1)
    column[kept] = np.arange(len(kept))
    use = column[feat] >= 0
    doc, col = doc[use], column[feat[use]]
    telling = np.bincount(doc, weights=(odds[kept] > 0)[col], minlength=len(rows))
    lo, hi = np.quantile(telling[y == 1], [1 / 3, 2 / 3])
    grade = np.where(y == 0, 0, 1 + (telling > lo).astype(int) + (telling > hi).astype(int))
    # parameters: shared weights, first threshold, logs of the further steps; Adam
    p = np.concatenate([np.zeros(len(kept)), [theta0], np.zeros(GRADES - 1)])
    m, v = np.zeros_like(p), np.zeros_like(p)
    over = (grade[:, None] > np.arange(GRADES)[None, :]).astype(float)
    for t in range(1, steps + 1):
        w, gaps = p[: len(kept)], np.exp(p[len(kept) + 1 :])
        theta = p[len(kept)] + np.concatenate([[0], np.cumsum(gaps)])
        score = np.bincount(doc, weights=w[col], minlength=len(rows))
        # cumulative probabilities and the grade's own: P(g) = A[g-1] - A[g]
        a = 1 / (1 + np.exp(np.clip(theta[None, :] - score[:, None], -500, 500)))
        edge = np.concatenate([np.ones((len(rows), 1)), a, np.zeros((len(rows), 1))], axis=1)
        own = np.maximum(np.take_along_axis(edge, grade[:, None], 1) - np.take_along_axis(edge, grade[:, None] + 1, 1), 1e-12)
        slope = np.concatenate([np.zeros((len(rows), 1)), a * (1 - a), np.zeros((len(rows), 1))], axis=1)
        d_hi = np.take_along_axis(slope, grade[:, None], 1) / own
        d_lo = np.take_along_axis(slope, grade[:, None] + 1, 1) / own
        g_score = -(d_hi - d_lo)[:, 0] / len(rows)
        g_theta = np.zeros(GRADES)
        for k in range(GRADES):
            g_theta[k] = (np.where(grade == k + 1, d_hi[:, 0], 0) - np.where(grade == k, d_lo[:, 0], 0)).sum() / len(rows)
        g = np.concatenate(
            [
                np.bincount(col, weights=g_score[doc], minlength=len(kept)) + ridge * w,
                [g_theta.sum()],
                [g_theta[k:].sum() * gaps[k - 1] for k in range(1, GRADES)],
            ]
        )
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    weight[kept] = p[: len(kept)]
    return OrdinalModel(weight, p[len(kept)] + np.concatenate([[0], np.cumsum(np.exp(p[len(kept) + 1 :]))]))


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> OrdinalModel:
    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column(2)
            at = 0
            for b in small_blocks([batch]):
                doc, feature = features(b)
                cut = np.searchsorted(doc, np.arange(len(b) + 1))
                sets = [pack_arrays(np.diff(feature[cut[i] : cut[i + 1]], prepend=0).astype(np.int32)) for i in range(len(b))]
                yield pa.RecordBatch.from_arrays(
                    [b.doc_ids(), pa.array(sets, pa.binary()), y.slice(at, len(b))], names=["doc_id", "features", "y"]
                )
                at += len(b)

    sample = labelled_sample(docs, labels, "toxic", max_rows).select("doc_id", "text", "y")
    rows = sorted(map(tuple, one_per_id(sample.mapInArrow(reduce, "doc_id long, features binary, y int"), "features").collect()))
    first = dict.fromkeys((bytes(x), y) for _, x, y in rows)  # equal documents count once
    sets = [np.cumsum(unpack_arrays(x)[0].astype(np.int64)) for x, _ in first]
    return fit_ordinal(sets, np.array([y for _, y in first], np.int64))


def score_toxicity(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """doc_id, severity (expected grade), p_toxic and grade of every document."""
    kept = np.flatnonzero(model.weight)
    state = docs.sparkSession.sparkContext.broadcast((kept, model.weight[kept], model.theta))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, w, theta = state.value
        weight = np.zeros(len(LEVELS) << BITS)
        weight[kept] = w
        mask = np.zeros(1 << BITS, bool)
        mask[kept // len(LEVELS)] = True
        fitted = OrdinalModel(weight, theta)
        for b in small_blocks(batches):
            doc, bucket = features(b, mask)
            p = fitted.above(np.bincount(doc, weights=weight[bucket], minlength=len(b)))
            yield pa.RecordBatch.from_arrays(
                [
                    b.doc_ids(),
                    pa.array(p.sum(axis=1), pa.float64()),
                    pa.array(p[:, 0], pa.float64()),
                    pa.array((p >= 0.5).sum(axis=1).astype(np.int32), pa.int32()),
                ],
                names=["doc_id", "severity", "p_toxic", "grade"],
            )

    return id_and_text(docs).mapInArrow(run, SCHEMA)


def drop_toxic(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """The rows of `docs`, all columns, that are not graded toxic."""
    kept = np.flatnonzero(model.weight)
    state = docs.sparkSession.sparkContext.broadcast((kept, model.weight[kept], model.theta))

    def make():
        kept, w, theta = state.value
        weight = np.zeros(len(LEVELS) << BITS)
        weight[kept] = w
        mask = np.zeros(1 << BITS, bool)
        mask[kept // len(LEVELS)] = True
        fitted = OrdinalModel(weight, theta)

        def keep(b: Block) -> np.ndarray:
            doc, feature = features(b, mask)
            return fitted.above(np.bincount(doc, weights=weight[feature], minlength=len(b)))[:, 0] < 0.5

        return keep

    return filter_documents(docs, make)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document graded: doc_id, held_out, severity, p_toxic, grade, toxic."""
    docs = documents(spark, sf_dir)
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "severity", "p_toxic", "grade", (F.col("grade") >= 1).alias("toxic")
    )
