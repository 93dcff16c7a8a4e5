import pytest

from recurra.llm import decontamination as D
from tests.llm.corpus import WORD, as_set, awkward, frame
from tests.llm.test_jaccard import LOWER

ITEMS = "item_id long, text string, n long"


def grams(t, n):
    w = WORD.findall((t or "").translate(LOWER))
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if n else set()


def brute(rows, items):
    out = []
    for j, t in items:
        n = min(5, len(WORD.findall(t or "")))
        q = grams(t, n)
        for i, d in rows:
            shared = len(q & grams(d, n))
            if q and 100 * shared >= 75 * len(q):
                out.append((i, j, shared, len(q)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("item_bytes", [D.ITEM_BYTES, 600])
def test_containment(spark, item_bytes):
    rows = awkward()
    words = [t.split() for _, t in rows if t and len(t.split()) > 60]
    items = [(k, " ".join(w[k : k + 12 + 3 * k])) for k, w in enumerate(words[:15])]
    items += [(20, " ".join(words[0][:20] + ["other"] * 4)), (21, "three w1 w2"), (22, "ONE TWO three"), (23, "one"), (24, ""), (25, None), (26, " ")]
    items += [items[0], (None, items[1][1])]
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], ITEMS)
    got = D.contained_items(frame(spark, rows), bench, item_bytes)
    want = brute(rows, items)
    assert want and as_set(got) == want
    clean = D.drop_contaminated(frame(spark, rows), bench, item_bytes)
    dirty = [r for r in rows if brute([r], items)]
    assert sorted(map(repr, (tuple(r) for r in clean.select("doc_id", "text").collect()))) == sorted(map(repr, (r for r in rows if r not in dirty)))


def test_empty(spark):
    bench = spark.createDataFrame([(1, "one two three four five", 1)], ITEMS)
    assert D.contained_items(frame(spark, []), bench).count() == 0
    assert D.contained_items(frame(spark, awkward()), bench.limit(0)).count() == 0


def test_repeated_items_are_broadcast_once(spark):
    text = "one two three four five six seven"
    items = [(1, text)] * 30_000 + [(1, text + " eight")] * 3 + [(None, text)] * 2 + [(2, None), (3, "")] * 2000
    bench = spark.createDataFrame(items, "item_id long, text string")
    blocks = [b.value for b in D.item_blocks(bench, 1000)]
    assert sum(len(ids) for ids, *_ in blocks) == 3
    docs = frame(spark, [(7, "ONE two three four five six seven"), (8, "one two three four"), (None, text + " eight")])
    got = D.contained_items(docs, bench, 1000).groupBy("doc_id", "item_id", "n_shared", "n_item").count().collect()
    want = [(d, i, 3, 3, n) for d in (7, None) for i, n in ((1, 30_000), (None, 2))] + [(7, 1, 3, 4, 3), (None, 1, 4, 4, 3)]
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, want))
    assert [r["doc_id"] for r in D.drop_contaminated(docs, bench, 1000).collect()] == [8]
