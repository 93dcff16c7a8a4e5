"""Held-out accuracy, and the awkward rows."""

import numpy as np
from pyspark.sql import functions as F

from recurra.llm import quality, toxicity
from recurra.llm.common import Block
from tests.llm.corpus import awkward, frame

DIR = "/root/testdata/sf0.1"
LABELS = "doc_id long, quality int, toxic int"


def held(df, label, spark):
    labels = spark.read.parquet(f"{DIR}/labels.parquet").select("doc_id", F.col(label).alias("y"))
    return df.join(labels, "doc_id").filter("held_out")


def test_toxicity_held_out(spark):
    got = held(toxicity.op5_toxicity(spark, DIR), "toxic", spark).groupBy("y").agg(F.avg(F.col("toxic").cast("int")).alias("flagged"), F.avg("severity").alias("s")).collect()
    flagged = {r["y"]: r["flagged"] for r in got}
    severity = {r["y"]: r["s"] for r in got}
    assert flagged[1] > 0.8 and flagged[0] < 0.015 and severity[1] > 10 * severity[0]


def test_quality_held_out(spark):
    got = held(quality.op4_quality(spark, DIR), "quality", spark)
    rows = got.groupBy("y").agg(F.avg(F.expr("predicted = y").cast("int")).alias("right"), F.avg(F.pow(F.col("score") - F.col("y"), 2)).alias("brier")).collect()
    right = {r["y"]: r["right"] for r in rows}
    assert right[1] > 0.98 and right[0] > 0.7
    assert sum(r["brier"] for r in rows) / 2 < 0.15


def test_awkward_rows(spark):
    rows = awkward()
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(i, k % 2, (k // 2) % 2) for k, (i, _) in enumerate(rows)] + [(None, 1, 1), (1, None, None), (9999, 0, 1)], LABELS)
    vectors, net = quality.fit_quality(docs, labels)
    scores = quality.score_quality(docs, vectors, net).collect()
    assert len(scores) == len(rows) and all(0 <= r["score"] <= 1 for r in scores)
    model = toxicity.fit_toxicity(docs, labels)
    graded = toxicity.score_toxicity(docs, model).collect()
    assert len(graded) == len(rows) and all(0 <= r["p_toxic"] <= 1 and 0 <= r["severity"] <= 3 for r in graded)
    assert toxicity.drop_toxic(docs, model).count() == sum(r["p_toxic"] < 0.5 for r in graded)


def test_an_id_of_many_rows_is_learned_once(spark):
    docs = frame(spark, [(0, f"good w{k}") for k in range(300)] + [(7, "bad"), (8, None), (2, "held out")])
    labels = spark.createDataFrame([(0, 1, 0), (7, 0, 1), (8, 1, 0), (2, 0, 1)], LABELS)
    sample = toxicity.labelled_sample(docs, labels, "toxic", 8)
    assert sample.count() == 302
    one = toxicity.one_per_id(sample.withColumnRenamed("text", "features"), "features").collect()
    assert sorted(r["doc_id"] for r in one) == [0, 7, 8]
    assert toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels)).count() == 303


def test_no_labels_and_no_rows(spark):
    none = spark.createDataFrame([], LABELS)
    docs = frame(spark, [(1, "a b"), (2, None)])
    vectors, net = quality.fit_quality(docs, none)
    assert {r["score"] for r in quality.score_quality(docs, vectors, net).collect()} == {0.5}
    model = toxicity.fit_toxicity(docs, none)
    assert toxicity.drop_toxic(docs, model).count() == 2
    empty = frame(spark, [])
    vectors, net = quality.fit_quality(empty, none)
    assert quality.score_quality(empty, vectors, net).count() == 0
    assert toxicity.score_toxicity(empty, toxicity.fit_toxicity(empty, none)).count() == 0


def test_words_have_vectors_of_their_own():
    words = 20_000
    bucket, _ = quality.tokens(Block.of([1], [" ".join(f"w{chr(97 + k % 26)}{''.join(chr(97 + int(c)) for c in str(k))}" for k in range(words)).encode()]))
    assert len(bucket) == words and len(np.unique(bucket)) > 0.9 * words


def test_neighbours_of_every_token():
    text = " ".join("abcdefgh"[k * k % 8] for k in range(3 * quality.PIECE)).encode()
    t, doc = quality.tokens(Block.of([1, 2], [text, b"a b"]))
    want = np.zeros((quality.BUCKETS, quality.DIM), np.int64)
    for step in (1, 2):
        near = doc[step:] == doc[:-step]
        pair, n = np.unique(np.stack([t[:-step][near], t[step:][near]]), axis=1, return_counts=True)
        for (x, y), k in zip(pair.T, n):
            want[x] += k * quality.index_vectors()[y].astype(np.int64)
            want[y] += k * quality.index_vectors()[x].astype(np.int64)
    got = np.zeros_like(want)
    for bucket, near in quality.near_sums(t, doc):
        got[bucket] += near
    assert (got == want).all()


def test_bad_documents_held_out(spark):
    got = held(quality.op4_quality(spark, DIR), "quality", spark)
    right = {r["y"]: r["right"] for r in got.groupBy("y").agg(F.avg(F.expr("predicted = y").cast("int")).alias("right")).collect()}
    print("held out, right by label:", right)
    assert right[0] > 0.85 and right[1] > 0.98
