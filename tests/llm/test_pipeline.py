"""Each stage of the pipeline against a plain version, on its own input."""

import hashlib

import corpus_pipeline as P
from recurra.llm import toxicity
from tests.llm.corpus import awkward, frame
from tests.llm.test_decontamination import brute as leaks
from tests.llm.test_jaccard import shingles
from tests.llm.test_repeats import brute_words, split


def pairs(df):
    return sorted(map(repr, (tuple(r) for r in df.select("doc_id", "text").collect())))


def test_stages(spark, tmp_path):
    sf = str(tmp_path)
    rows = awkward()
    frame(spark, rows).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 7 == 0)) for i, _ in rows if i is not None], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    items = [(1, " ".join(rows[3][1].split()[:14]) if rows[3][1] else "x"), (2, "w1 w2 w3 w4 w5 w6"), (3, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    schema = docs.schema
    for k, (name, stage) in enumerate(P.STAGES):
        before = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        out = stage(spark, docs, sf)
        out.write.parquet(f"{sf}/out{k}")
        after = spark.read.parquet(f"{sf}/out{k}")
        if k < 4:
            assert after.schema == schema
        if name == "toxicity":
            model = toxicity.fit_toxicity(docs, spark.read.parquet(f"{sf}/labels.parquet"))
            bad = toxicity.score_toxicity(docs, model).filter("p_toxic >= 0.5").count()
            assert after.count() == len(before) - bad
        elif name == "jaccard_join":
            left = [shingles(r["text"]) for r in after.collect()]
            assert not any(a and 100 * len(a & b) >= 75 * len(a | b) for x, a in enumerate(left) for b in left[:x])
            gone = len(before) - len(left)
            assert gone >= 40 and set(pairs(after)) <= set(map(repr, before))
        elif name == "substring_dedup":
            want = {}
            for i, t in before:
                want.setdefault(i, []).append(t)
            sha = sorted(x[3] for x in brute_words(before) if not (x[1] and x[1] == x[2]))
            assert sorted(hashlib.sha256(b" ".join(split(r["text"]))).hexdigest() for r in after.collect()) == sha
            assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in after.collect())
        elif name == "decontamination":
            assert pairs(after) == sorted(map(repr, (r for r in before if not leaks([r], items))))
        else:
            assert {r["doc_id"] for r in after.collect()} == {i for i, _ in before}
        docs = after
    whole = P.run(spark, sf)
    cols = ["doc_id", "start", "length", "ids_crc32"]
    total = lambda df: sum(r["length"] for r in df.select(cols).collect())
    assert total(whole) == total(docs)
