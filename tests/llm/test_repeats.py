"""Byte and word dedup against brute force."""

import copy
import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from recurra.llm import substrings, suffixes
from recurra.llm.common import Block
from recurra.llm.repeats import HOT, Seq
from tests.llm.corpus import as_set, awkward, frame


def _sha(x):
    return hashlib.sha256(x).hexdigest()


def brute_bytes(rows, length=400):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[p : p + length] for _, t in texts for p in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        spans = sum(1 for k in range(len(t)) if gone[k] and not (k and gone[k - 1]))
        out.append((i, len(t), sum(gone), spans, _sha(bytes(c for c, g in zip(t, gone) if not g))))
    return sorted(out, key=repr)


def split(t):
    return [w for w in (t or "").encode().translate(bytes(32 if 9 <= c <= 13 else c for c in range(256))).split(b" ") if w]


def brute_words(rows, length=13):
    rank = lambda i: float("inf") if i is None else i
    first = {}
    for i, t in rows:
        w = split(t)
        for p in range(len(w) - length + 1):
            k = tuple(w[p : p + length])
            first[k] = min(first.get(k, rank(None)), rank(i))
    out = []
    for i, t in rows:
        w = split(t)
        gone = [False] * len(w)
        for p in range(len(w) - length + 1):
            if first[tuple(w[p : p + length])] < rank(i):
                gone[p : p + length] = [True] * length
        out.append((i, len(w), sum(gone), _sha(b" ".join(x for x, g in zip(w, gone) if not g))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [HOT, 0])  # 0: every group of several contexts goes the way of hot ones
def test_bytes(spark, hot):
    rows = awkward()
    got = suffixes.remove_repeats(frame(spark, rows), hot)
    assert as_set(got.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))) == brute_bytes(rows)


@pytest.mark.parametrize("hot", [HOT, 0])
def test_words(spark, hot):
    rows = awkward()
    got = substrings.remove_repeats(frame(spark, rows), hot)
    assert as_set(got.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256))) == brute_words(rows)


def test_empty(spark):
    assert suffixes.remove_repeats(frame(spark, [])).count() == 0
    assert substrings.remove_repeats(frame(spark, [])).count() == 0


def test_loser_tree_merges_front_coded_runs():
    import random

    rng = random.Random(1)
    runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 9))) for _ in range(rng.randrange(0, 40))) for _ in range(7)]
    merged = list(suffixes.merge_runs([suffixes.decode(*suffixes.front_code(r)) for r in runs]))
    strings = [s for s, _, _ in merged]
    assert strings == sorted(x for r in runs for x in r)
    assert [n for _, n, _ in merged[1:]] == [suffixes.common_prefix(a, b) for a, b in zip(strings, strings[1:])]


def test_suffix_automaton_matches():
    import random

    rng = random.Random(2)
    for _ in range(60):
        seqs = [[b"%d" % rng.randrange(3) for _ in range(rng.randrange(0, 14))] for _ in range(4)]
        sam = substrings.SuffixAutomaton()
        for s in seqs[:-1]:
            sam.add(s)
        have = {tuple(s[i : i + 3]) for s in seqs[:-1] for i in range(len(s) - 2)}
        want = [e for e in range(2, len(seqs[-1])) if tuple(seqs[-1][e - 2 : e + 1]) in have]
        assert sam.matches(seqs[-1], 3) == want


def test_texts_of_many_pieces(spark, monkeypatch):
    rows = awkward()
    monkeypatch.setattr(suffixes.FINDER, "piece", 700)
    got = suffixes.remove_repeats(frame(spark, rows))
    assert as_set(got.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))) == brute_bytes(rows)
    monkeypatch.setattr(substrings.FINDER, "piece", 50)
    got = substrings.remove_repeats(frame(spark, rows))
    assert as_set(got.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256))) == brute_words(rows)


def test_pieces_give_the_contexts_of_the_whole():
    block = Block.of([i for i, _ in awkward()], [None if t is None else t.encode() for _, t in awkward()])
    for find, piece in ((suffixes.FINDER, 300), (substrings.FINDER, 9)):
        whole = find.entries(block)[2:]
        small = copy.copy(find)
        small.piece = piece
        for x, y in zip(whole, small.entries(block)[2:]):
            assert (x == y).all()


def test_a_text_of_over_2_28_symbols():
    n = (1 << 28) + 5000
    values = np.resize(np.random.default_rng(1).integers(0, 256, 1_000_003, np.uint8), n)
    seq = Seq(values, np.array([0]), np.array([n]))
    far = [seq.contexts_from(a, suffixes.LENGTH, suffixes.SPREAD, suffixes.GRAM) for a in (0, 1 << 28)]
    assert far[1][3][-1] == n - suffixes.LENGTH
    _, anchor, lo, hi = seq.contexts(suffixes.LENGTH, suffixes.SPREAD, suffixes.GRAM)
    assert lo[0] == 0 and hi[-1] == n - suffixes.LENGTH and (lo[1:] == hi[:-1] + 1).all()
    k = (1 << 28) // 1_000_003 * 1_000_003
    assert (seq.span(np.array([5, k + 5]), np.array([405, k + 405])) == seq.span(np.array([5, 5]), np.array([405, 405]))).all()
