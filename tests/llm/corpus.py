"""Small tables with the awkward cases every operator has to take."""

from __future__ import annotations

import random
import re

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use inside
        T.StructField("block", T.StringType()),
        T.StructField("key", T.IntegerType()),
        T.StructField("n", T.DoubleType()),
        T.StructField("shard", T.ArrayType(T.LongType())),
        T.StructField("payload", T.BinaryType()),
    ]
)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows):
    """`rows`: (doc_id, text)."""
    full = [(i, t, None if k % 3 else "en", "s" if k % 2 else None, None if t is None else len(t), "x", k, None, [k], b"z") for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).repartition(5)


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def awkward(seed=3):
    """Copies, near copies, shared passages, overlaps, ties, empty and null texts and ids, one long text."""
    rng = random.Random(seed)
    passage, line = sentence(rng, 90), sentence(rng, 30)
    rows = [(i, sentence(rng, rng.randrange(1, 120))) for i in range(0, 60)]
    rows += [(100 + i, sentence(rng, 20) + " " + passage + "\n" + sentence(rng, 20)) for i in range(12)]
    base = sentence(rng, 160).split(" ")
    for i in range(40):  # a large group of near copies
        w = list(base)
        for _ in range(rng.randrange(0, 9)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(30)}"
        rows.append((200 + i, " ".join(w)))
    rows += [(300 + i, "  ".join(base)) for i in range(9)]  # equal words, other white space
    rows += [(400 + i, rows[0][1]) for i in range(5)]
    rows += [(500, (line + "\n") * 40), (501, line), (502, "a " * 700), (503, "A " * 350 + "b"), (504, "é" * 900), (505, "ü ñ 漢字 🙂 " * 120)]
    rows += [(600, None), (601, ""), (602, " \n\t "), (603, "one"), (604, "One"), (605, "one two three"), (606, passage.upper())]
    rows += [(None, passage), (None, "one two three"), (None, None), (0, rows[0][1]), (0, "another text under the same id " + passage)]
    rows += [(700, sentence(rng, 6000) + " " + passage)]
    rng.shuffle(rows)
    return rows


def as_set(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
