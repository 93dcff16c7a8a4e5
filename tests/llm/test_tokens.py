"""Token counts and packing against the libraries."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from recurra.llm import packing, token_counts
from tests.llm.corpus import awkward, frame

PIECES = [" ", " ", "\n", "a", "b", "the", "▁", "  ", "é", "①", "\t", "<s>", "ﬁ", "　", "日本", "🙂", "\x00", "<0x0A>", "x", "\r", "    ", "in", "ing"]
PIECES += ["tion", "</s>", "<unk>", "\xa0", "​", "'s", "1", "２", "!", "...", "\x1c", "\x85", "﻿", "\n\n", "ⅷ", "<|endoftext|>", "\x1f", "don't"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(6)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randrange(0, 16))) for _ in range(8000)] + [t or "" for _, t in awkward()]


def test_counts_equal_the_library(texts):
    path = public_tokenizers.path("piece_bpe_32k.model")
    merger = token_counts.PairMerger(path, most=500)
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    assert [merger.count(t) for t in texts] == [len(x) for x in sp.encode(texts, num_threads=1)]


def test_ids_equal_the_library(texts):
    path = public_tokenizers.path("byte_bpe_50k.json")
    cache = packing.IdCache(path, most=500)
    tok = Tokenizer.from_file(path)
    rng = random.Random(7)
    end = "<|endoftext|>"
    texts = texts + [end, f"{end} a b", f"a {end} b", f"a b {end}", f"a\n{end}\nb", f"a{end}b", end * 3, "<|endoftext", f" {end}  a"]
    texts += ["".join(rng.choice([end, " ", "\n", "a", "of the", "<|", "|>"]) for _ in range(rng.randrange(1, 9))) for _ in range(500)]
    want = [np.array(e.ids, "<u4").tobytes() for e in tok.encode_batch(texts, add_special_tokens=False)]
    got = [x for k in range(0, len(texts), 100) for x in cache.encode(texts[k : k + 100])]
    assert got == want


def test_known_words_are_looked_up_once():
    cache = packing.IdCache(public_tokenizers.path("byte_bpe_50k.json"))
    text = "one two\nthree two four\nfive"
    want = cache.encode([text])
    asked = []

    class Counting(dict):
        def get(self, w):
            asked.append(w)
            return super().get(w)

        def __getitem__(self, w):
            asked.append(w)
            return super().__getitem__(w)

        def __contains__(self, w):
            asked.append(w)
            return super().__contains__(w)

    cache.known = Counting(cache.known)
    assert cache.encode([text]) == want and asked == ["two", "\nthree", "two", "four", "\nfive"]


def test_count_rows(spark):
    rows = awkward()
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = sorted((tuple(r) for r in token_counts.count_tokens(frame(spark, rows), limit=100).collect()), key=repr)
    n = [len(sp.encode(t or "")) for _, t in rows]
    assert got == sorted(((i, len((t or "").encode()), c, c > 100) for (i, t), c in zip(rows, n)), key=repr)
    assert token_counts.count_tokens(frame(spark, [])).count() == 0


def test_pack_lengths_hold_every_token_once():
    rng = random.Random(9)
    for _ in range(200):
        lengths = [rng.choice([1, 2, 300, 1025, 2047, 2048, 2049, 5000, rng.randint(1, 4000)]) for _ in range(rng.randrange(0, 50))]
        seqs = packing.pack_lengths(lengths)
        have: dict[int, list] = {}
        for tier, seq in seqs:
            assert tier <= 2048 and tier & (tier - 1) == 0 and sum(n for _, _, n in seq) == tier
            for d, s, n in seq:
                have.setdefault(d, []).append((s, n))
        for d, n in enumerate(lengths):
            at = 0
            for s, k in sorted(have[d]):
                assert s == at and k > 0
                at += k
            assert at == n


def test_step_groups_are_balanced():
    rng = random.Random(5)
    sizes = [rng.choice(packing.TIERS) for _ in range(500)]
    load: dict[int, int] = {}
    for s, g in zip(sizes, packing.step_groups(sizes)):
        load[g] = load.get(g, 0) + s
    assert max(load.values()) - min(load.values()) <= 2 * max(packing.TIERS)


def test_packing_round_trip(spark):
    rows = [(k, t) for k, (_, t) in enumerate(awkward())] + [(None, "no id"), (901, "a <|endoftext|> b"), (902, "<|endoftext|>")]
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = packing.pack(frame(spark, rows), group_tokens=3000).collect()
    docs, seqs = {}, {}
    for r in got:
        assert len(r["ids"]) == 4 * r["length"] and r["length"] > 0
        docs.setdefault(r["doc_id"], []).append((r["start"], r["ids"], r["doc_tokens"]))
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, t in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, packing.END_ID]
        raw = b"".join(x for _, x, _ in sorted(docs[i]))
        assert zlib.crc32(raw) == zlib.crc32(np.array(ids, "<u4").tobytes()) and {n for _, _, n in docs[i]} == {len(ids)}
    for pieces in seqs.values():
        at = 0
        for o, n in sorted(pieces):
            assert o == at
            at += n
        assert at <= 2048 and at & (at - 1) == 0
    assert packing.pack(frame(spark, [])).count() == 0
