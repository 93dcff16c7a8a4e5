"""Ranked search against plain counting, and in SQL."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import types as T

from recurra.llm import ranking
from tests.llm.corpus import awkward, frame

ITEMS = T.StructType(
    [T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("doc_id", T.StringType()), T.StructField("grp", T.LongType())]
)
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ASKED = [(1, "w1 w2 W3 w1"), (1, "w1 w2 W3 w1"), (2, "é漢字 ü, ñ"), (3, None), (4, ""), (5, "nowhere"), (None, "one TWO three")]
ASKED += [(6, "w5"), (6, "a w6"), (7, " ".join(f"w{i}" for i in range(400))), (8, "w1-w2.w3_w4"), (9, "🙂 Ａ"), (10, "a b")]


def items(spark, rows):
    return spark.createDataFrame([(i, t, "x", k) for k, (i, t) in enumerate(rows)], ITEMS).repartition(3)


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def by_hand(docs, asked, top=20):
    have = [(i, Counter(t)) for i, text in docs if (t := terms(text))]
    n, total = len(have), sum(sum(c.values()) for _, c in have)
    df = Counter(t for _, c in have for t in c)
    out = []
    for item in {i for i, _ in asked}:
        want = Counter(t for text in {text for i, text in asked if i == item} for t in terms(text))
        scored = []
        for i, c in have:
            m = 75 + 25 * sum(c.values()) * n // total
            s = sum(
                k * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t, k in want.items() if c[t]
            )
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("owners,slice_bytes,block,group", [(3, 8 << 20, 4096, 256), (2, 2000, 17, 3), (1, 1, 40, 1)])
def test_equals_plain_counting(spark, monkeypatch, owners, slice_bytes, block, group):
    monkeypatch.setattr(ranking, "BLOCK_DOCS", block)
    monkeypatch.setattr(ranking, "GROUP_ITEMS", group)
    asked = ASKED if slice_bytes > 1 else [(1, "w1 w2")]
    docs = awkward()
    got = ranking.search(frame(spark, docs), items(spark, asked), owners=owners, slice_bytes=slice_bytes)
    assert rows_of(got) == by_hand(docs, asked)


def test_ties_and_many_equal_documents(spark):
    docs = [(i, "same words here") for i in range(300, 0, -1)] + [(7, "same words here"), (None, "same")]
    asked = [(1, "same"), (2, "here there")]
    assert rows_of(ranking.search(frame(spark, docs), items(spark, asked))) == by_hand(docs, asked)


def test_nothing(spark):
    assert ranking.search(frame(spark, []), items(spark, ASKED)).count() == 0
    assert ranking.search(frame(spark, awkward()), items(spark, [])).count() == 0
    assert ranking.search(frame(spark, [(1, None), (2, " ,")]), items(spark, [(1, None), (2, "a")])).count() == 0


def test_equal_hashes_are_told_apart(monkeypatch):
    rng = random.Random(5)
    monkeypatch.setattr(ranking, "word_hashes", lambda buf, start, end: (end - start).astype(np.uint64))
    words = sorted({("".join(rng.choice("abc") for _ in range(rng.randint(1, 4)))).encode() for _ in range(60)})
    kept = words[::2]
    v = ranking.Vocabulary(kept)
    text = b" ".join(rng.choice(words) for _ in range(500))
    t = ranking.Terms(ranking.Block.of([1], [text]))
    hit, number = v.find(t)
    got = sorted((int(h), kept[n]) for h, n in zip(hit, number))
    assert got == sorted((k, w) for k, w in enumerate(text.split(b" ")) if w in kept)


def test_sql_says_the_same(spark, tmp_path):
    frame(spark, awkward()).write.parquet(f"{tmp_path}/documents.parquet")
    items(spark, ASKED).write.parquet(f"{tmp_path}/benchmark.parquet")
    out = ranking.op13_search(spark, str(tmp_path))
    assert out.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    assert rows_of(out) == sorted(con.execute(ranking.OP13_SQL).fetchall(), key=repr)
