"""Classes of the Jaccard join against brute force."""

import numpy as np

from recurra.llm import jaccard
from tests.llm.corpus import WORD, as_set, awkward, frame

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(t):
    w = WORD.findall((t or "").translate(LOWER))
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                up[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[top(k)] = min(i, least.get(top(k), i))
    return sorted(((i, len(s), least.get(top(k)) if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets))), key=repr)


def test_classes(spark):
    rows = awkward()
    assert as_set(jaccard.jaccard_classes(frame(spark, rows))) == brute(rows)


def test_long_lists_of_unlike_documents(spark):
    """Many documents share most of a passage, some closely enough and some not."""
    import random

    rng = random.Random(8)
    base = [f"b{k}" for k in range(60)]
    rows = [(i, " ".join(base[: rng.randrange(30, 60)] + [f"u{i}-{k}" for k in range(rng.randrange(0, 25))])) for i in range(120)]
    assert as_set(jaccard.jaccard_classes(frame(spark, rows))) == brute(rows)


def segments(n, of=24, take=12, words=8, seed=5):
    """Documents of some of the same segments, a few of them near copies."""
    import random

    rng = random.Random(seed)
    parts = [" ".join(f"s{k}w{j}" for j in range(words)) for k in range(of)]
    rows = []
    for i in range(n):
        chosen = sorted(rng.sample(range(of), take)) if i % 10 or not rows else rows[rng.randrange(len(rows))][2]
        rows.append((i, " ".join(parts[k] for k in chosen) + (f" tail{i}" if i % 3 else ""), chosen))
    return [(i, t) for i, t, _ in rows]


def test_documents_of_shared_segments(spark):
    rows = segments(150)
    assert as_set(jaccard.jaccard_classes(frame(spark, rows))) == brute(rows)


def test_sizes_around_the_bound(spark):
    """Nested sets and sets with a tail of their own, pairs of each size close to
    the link, among many that share the same middle."""
    base = [f"b{k}" for k in range(100)]
    rows = [(i, " ".join(base[: 60 + i % 40] + [f"t{i // 2}-{k}" for k in range(i % 7 * 3)])) for i in range(160)]
    assert as_set(jaccard.jaccard_classes(frame(spark, rows))) == brute(rows)


def test_a_passage_too_short_to_link_gives_no_pairs():
    """Lists in nobody's head: no candidates, however many documents hold them."""
    n = 1000
    token, node = np.zeros(n, np.uint64), np.arange(n, dtype=np.uint64)
    size, ask = np.full(n, 100), np.ones(n, np.uint8)
    assert len(jaccard.pairs_of_lists(token, node, size, size, ask, np.zeros(n, bool))[0]) == 0
    one = np.zeros(n, bool)
    one[5] = True
    size[5] = 90
    got = jaccard.pairs_of_lists(token, node, size, size, ask, one)
    assert len(got[0]) == n - 1 and not got[4].any()


def test_sketches_differ_in_no_more_bits_than_shingles():
    rng = np.random.default_rng(3)
    for _ in range(50):
        both, x, y = (rng.integers(0, 1 << 48, k, dtype=np.uint64) for k in rng.integers(0, 400, 3))
        a, b = jaccard.sketch(np.concatenate([both, x])), jaccard.sketch(np.concatenate([both, y]))
        assert sum(int(v).bit_count() for v in (a ^ b).view(np.uint64)) <= len(x) + len(y)


def test_empty(spark):
    assert jaccard.jaccard_classes(frame(spark, [])).count() == 0


def test_one_of_each_stays(spark):
    rows = awkward()
    docs = frame(spark, rows)
    kept = jaccard.keep_one_of_each(docs)
    assert kept.schema == docs.schema
    classes = {}
    for k, (i, n, c) in enumerate(brute(rows)):
        classes.setdefault(("none", k) if not n else c if c is not None else ("null", n), []).append(i)
    # classes that share their smallest id (repeated ids with other texts) are counted by brute force below
    sets = {}
    for i, t in rows:
        s = frozenset(shingles(t))
        sets.setdefault(s, []).append(i)
    got = kept.select("doc_id", "text").collect()
    assert len({frozenset(shingles(r["text"])) for r in got if shingles(r["text"])}) == sum(1 for r in got if shingles(r["text"]))
    assert sum(1 for r in got if not shingles(r["text"])) == sum(1 for _, t in rows if not shingles(t))
    links = [
        (a, b)
        for x, a in enumerate(got)
        for b in got[:x]
        if shingles(a["text"]) and 100 * len(shingles(a["text"]) & shingles(b["text"])) >= 75 * len(shingles(a["text"]) | shingles(b["text"]))
    ]
    assert not links
