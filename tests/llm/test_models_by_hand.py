"""The models' arithmetic against plain loops: pooling, the network's scores,
the sparse features, and the minimum that the ordinal fit stops at."""

import math
import random
import re

import numpy as np
import pytest

from recurra.llm import quality, toxicity
from recurra.llm.common import Block, word_hashes
from tests.llm.corpus import awkward

ROWS = awkward()


def block():
    return Block.of([i for i, _ in ROWS], [None if t is None else t.encode() for _, t in ROWS])


@pytest.mark.parametrize("piece", [quality.PIECE, 7])
def test_pooling(monkeypatch, piece):
    monkeypatch.setattr(quality, "PIECE", piece)
    vectors = np.random.default_rng(1).normal(0, 1, (quality.BUCKETS, quality.DIM)).astype(np.float32)
    b = block()
    token, doc = quality.tokens(b)
    got = quality.pooled(b, vectors)
    for d in range(len(b)):
        mine = vectors[token[doc == d]].astype(float)
        want = np.concatenate([mine.mean(axis=0), mine.std(axis=0)]) if len(mine) else np.zeros(2 * quality.DIM)
        assert np.allclose(got[d], want, atol=2e-3)


def test_scores_of_the_network():
    rng = np.random.default_rng(2)
    size = 2 * quality.DIM
    parts = (rng.normal(size=size), rng.uniform(0.5, 2, size), rng.normal(size=(size, 5)), rng.normal(size=5), rng.normal(size=5), 0.3, 1.7)
    x = rng.normal(size=(9, size))
    got = quality.Network(*parts).score(x)
    mean, scale, w1, b1, w2, b2, temperature = parts
    for row, p in zip(x, got):
        hidden = [math.tanh(sum((row[i] - mean[i]) / scale[i] * w1[i, k] for i in range(size)) + b1[k]) for k in range(5)]
        logit = sum(h * w for h, w in zip(hidden, w2)) + b2
        assert math.isclose(p, 1 / (1 + math.exp(-logit / temperature)), rel_tol=1e-9)


def test_temperature_minimises_held_back_loss():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 2 * quality.DIM))
    y = (x[:, 0] + 0.8 * rng.normal(size=900) > 0).astype(np.int64)
    net = quality.fit_network(x, y, steps=150)
    cal = np.random.default_rng(5).permutation(900)[:150]

    def loss(t):
        p = quality.Network(*net.parts[:-1], t).score(x[cal])
        return -(y[cal] * np.log(p) + (1 - y[cal]) * np.log(1 - p)).mean()

    best = net.parts[-1]
    assert loss(best) <= min(loss(best * 1.05), loss(best / 1.05)) + 1e-6


def test_sparse_features():
    doc, feature = toxicity.features(block())
    want = set()
    for d, (_, text) in enumerate(ROWS):
        count = {}
        for word in re.findall(rb"[0-9A-Za-z\x80-\xff]+", (text or "").encode()):
            word = word.lower() if word.isascii() else bytes(c + 32 if 65 <= c <= 90 else c for c in word)
            for part in [word] + [word[:n] for n in toxicity.BEGINNINGS if len(word) > n]:
                h = word_hashes(np.frombuffer(part + b"\n", np.uint8), np.array([0]), np.array([len(part)]))[0]
                bucket = int(h) >> (64 - toxicity.BITS)
                count[bucket] = count.get(bucket, 0) + 1
        want |= {(d, bucket * len(toxicity.LEVELS) + k) for bucket, n in count.items() for k, least in enumerate(toxicity.LEVELS) if n >= least}
    assert set(zip(doc.tolist(), feature.tolist())) == want and len(doc) == len(want)


def ordinal_sample(n=240):
    rng = random.Random(9)
    rows, y = [], []
    for _ in range(n):
        toxic = rng.random() < 0.4
        have = {f for f in range(12) if rng.random() < ((0.75 if f < 6 else 0.2) if toxic else (0.1 if f < 6 else 0.6))}
        rows.append(np.array(sorted(4 * f for f in have), np.int64))
        y.append(int(toxic))
    return rows, np.array(y)


def test_ordinal_fit_stops_at_the_minimum():
    rows, y = ordinal_sample()
    ridge = 1e-2
    model = toxicity.fit_ordinal(rows, y, steps=6000, rate=0.01, ridge=ridge)
    kept = np.flatnonzero(model.weight)
    assert len(kept) >= 6 and (np.diff(model.theta) > 0).all()
    telling = np.array([sum(model.weight[f] > 0 for f in r) for r in rows])
    lo, hi = np.quantile(telling[y == 1], [1 / 3, 2 / 3])
    grade = np.where(y == 0, 0, 1 + (telling > lo) + (telling > hi))

    def loss(weight, theta):
        total = 0.0
        for r, g in zip(rows, grade):
            s = sum(weight[f] for f in r)
            edge = [1.0, *[1 / (1 + math.exp(t - s)) for t in theta], 0.0]
            total -= math.log(edge[g] - edge[g + 1])
        return total / len(rows) + ridge / 2 * sum(weight[f] ** 2 for f in kept)

    step = 1e-4
    for f in kept:
        up, down = model.weight.copy(), model.weight.copy()
        up[f] += step
        down[f] -= step
        assert abs(loss(up, model.theta) - loss(down, model.theta)) / (2 * step) < 2e-3
    for k in range(toxicity.GRADES):
        up, down = model.theta.copy(), model.theta.copy()
        up[k] += step
        down[k] -= step
        assert abs(loss(model.weight, up) - loss(model.weight, down)) / (2 * step) < 2e-3


def test_severity_is_the_expected_grade():
    model = toxicity.OrdinalModel(np.zeros(1), np.array([-0.5, 0.4, 2.0]))
    for s in (-3.0, 0.0, 1.5):
        edge = [1.0, *[1 / (1 + math.exp(t - s)) for t in model.theta], 0.0]
        expected = sum(g * (edge[g] - edge[g + 1]) for g in range(4))
        assert math.isclose(model.above(np.array([s])).sum(), expected, rel_tol=1e-9)
