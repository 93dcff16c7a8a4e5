"""Byte-level BPE against the library, and back."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from recurra.llm import bpe_codec
from tests.llm.corpus import awkward, frame

PATH = public_tokenizers.path(bpe_codec.VOCABULARY)
PIECES = [" ", " ", "  ", "\n", "\t", "\r\n", "\xa0", "　", "\x1c", "\x85", "a", "b", "the", "The", "ing", "'s", "'ll", "é", "漢字", "🙂", "①", "٣"]
PIECES += ["1", "22", "!", "...", "<|endoftext|>", "\x00", "é", "ｆ", "x" * 70, "ab" * 60, "don't", "﻿", "_", "मनीष"]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe_codec.read_ranks(PATH), special_tokens={})


def ids(blob):
    return np.frombuffer(blob, "<i4").tolist()


@pytest.mark.parametrize("most", [40, 1 << 20])
def test_ids_equal_the_library(library, most):
    rng = random.Random(12)
    codec = bpe_codec.Codec(PATH, public_tokenizers.PATTERN, most=most)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(0, 14))) for _ in range(6000)] + [t or "" for _, t in awkward()]
    got = [x for k in range(0, len(texts), 500) for x in codec.encode(texts[k : k + 500])]
    assert [ids(x) for x in got] == [library.encode_ordinary(t) for t in texts]
    assert [codec.decode(np.frombuffer(x, "<i4")) for x in got] == [t.encode() for t in texts]


def test_every_character(library):
    codec = bpe_codec.Codec(PATH, public_tokenizers.PATTERN)
    texts = [f"a{chr(c)}b {chr(c)}1{chr(c)} {chr(c)}" for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    got = codec.encode(texts)
    assert [t for t, x in zip(texts, got) if ids(x) != library.encode_ordinary(t)] == []


def plain(piece, ranks):
    """Merge the leftmost least pair, looking at all pairs each time."""
    if piece in ranks:
        return [ranks[piece]]
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        best = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks), default=None)
        if best is None:
            return [ranks[p] for p in parts]
        parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]


def test_both_trees_equal_plain_merging():
    ranks = bpe_codec.read_ranks(PATH)
    forest = bpe_codec.Forest(ranks)
    rng = random.Random(3)
    for size in (2, 4, 8, 16, 32, 64):
        raw = [bytes(rng.choice(b"aeinst\xc3\xa9\xe6\xbc ") for _ in range(rng.randint(2, size))) for _ in range(300)]
        raw = [x for x in raw if x not in ranks]
        want = [plain(x, ranks) for x in raw]
        assert [bpe_codec.merge(x, ranks) for x in raw] == want
        assert [ids(x) for x in forest.merge(raw, size)] == want


def test_one_very_long_match(library):
    text = "abcdefgh" * 12_500
    codec = bpe_codec.Codec(PATH, public_tokenizers.PATTERN)
    assert ids(codec.encode([text])[0]) == library.encode_ordinary(text)


def test_rows(spark, library):
    rows = awkward() + [(801, "a <|endoftext|> b"), (801, "a <|endoftext|> b")]
    both = bpe_codec.decode(bpe_codec.encode(frame(spark, rows)))
    got = sorted(((r["doc_id"], list(r["ids"]), bytes(r["decoded"])) for r in both.collect()), key=repr)
    assert got == sorted(((i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows), key=repr)
    assert bpe_codec.encode(frame(spark, [])).count() == 0


def test_query_digests(spark, library, tmp_path):
    rows = awkward()
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    out = bpe_codec.op12_bpe_codec(spark, str(tmp_path))
    assert out.dtypes == [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    want = []
    for i, t in rows:
        x = library.encode_ordinary(t or "")
        want.append((i, len(x), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted((tuple(r) for r in out.collect()), key=repr) == sorted(want, key=repr)


def test_decode_any_ids(spark):
    df = spark.createDataFrame([(1, [220, 1, 50000]), (2, []), (3, None)], "doc_id long, ids array<int>")
    got = {r["doc_id"]: bytes(r["decoded"]) for r in bpe_codec.decode(df).collect()}
    table = {i: b for b, i in bpe_codec.read_ranks(PATH).items()}
    assert got == {1: table[220] + table[1] + table[50000], 2: b"", 3: b""}
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe_codec.decode(df.select("doc_id", F.array(F.lit(50256)).alias("ids"))).collect()
