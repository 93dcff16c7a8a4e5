"""Ranked lexical search by pipelined term partitioning.

The terms of all items are dealt to *owners*. A narrow pass over the documents
writes, for every block of documents and every owner, the postings of that
owner's terms. An *item bundle*, a group of items at one block, then travels
through the owners' stages one after the other: at each, a cogroup brings it
together with the owner's postings of the block, the owner adds the integer
contributions of its terms to the bundle's sparse document accumulators and
passes it on. After the last stage a bundle keeps its items' best documents,
and a window over these picks the best of all blocks.

Nothing grows past a bound in a task: a block has at most `BLOCK_DOCS`
documents and a group about `GROUP_ITEMS` items, so a bundle's accumulators do
too, and a term that every document holds is spread over all blocks. The item
terms reach the document pass by broadcast in slices of about `SLICE_BYTES`;
more items mean more slices (a pass each), not larger ones. Terms are found by
a 64-bit hash and then compared byte by byte.

score = sum over the item's terms, repeats included, of
w * ((1000000000 * tf) div (1000 * tf + 12 * m)), with
w = floor(1000 * ln((2N + 2) / (2 df + 1))) and m = 75 + ((25 n N) div L).

Defined cases: a null or empty text has no terms, so no score; such a document
or item gives no rows. Items are known by `item_id`: equal rows count once, and
the terms of different texts of one id (null is an id too) are put together.
Every document row counts and may be listed, repeated ids too; at equal scores
null document ids come last. Empty tables give no rows. Other columns, whatever
their names, are ignored. A text of any length is one document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recurra.llm.common import (
    Block,
    documents,
    id_and_text,
    lower_ascii,
    pack_arrays,
    rows_of,
    small_blocks,
    stage,
    sums,
    table,
    unpack_arrays,
    word_hashes,
)

TOP = 20
OWNERS = 3  # owners, and so stages, of a slice of terms
SLICE_BYTES = 8 << 20
BLOCK_DOCS = 4096
GROUP_ITEMS = 256

#: Bytes of terms: ASCII letters and digits, and all of characters beyond ASCII.
_IN_TERM = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


class Terms:
    """The terms of a block: `start`/`end` in `buf`, which has A-Z lower-cased,
    their hashes, and the document of each; `count` by document."""

    def __init__(self, block: Block):
        self.buf = lower_ascii(block.buf)
        edge = np.diff(np.concatenate([[False], _IN_TERM[self.buf], [False]]).view(np.int8))
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.hash = word_hashes(self.buf, self.start, self.end)
        first = np.searchsorted(self.start, np.concatenate([block.starts, [len(block.buf)]]))
        self.count = np.diff(first)
        self.doc = np.repeat(np.arange(len(block)), self.count)


class Vocabulary:
    """Some terms (bytes), numbered by their order here."""

    def __init__(self, terms: list[bytes]):
        self.size = len(terms)
        ends = np.cumsum([len(t) + 1 for t in terms]) if terms else np.zeros(0, np.int64)
        buf = np.frombuffer(b"".join([t + b"\n" for t in terms]), np.uint8)
        start = np.concatenate([[0], ends[:-1]]).astype(np.int64) if terms else ends
        hashes = word_hashes(buf, start, ends - 1)
        order = np.argsort(hashes, kind="stable")
        self.buf, self.number, self.hash = buf, order, hashes[order]
        self.start, self.length = start[order], (ends - 1 - start)[order]
        same = self.hash[1:] == self.hash[:-1]
        self.tries = 1  # the most terms that share a hash
        while same.any():
            self.tries += 1
            same = same[1:] & same[:-1]

    def find(self, t: Terms) -> tuple[np.ndarray, np.ndarray]:
        """Which terms of `t` are of this vocabulary, and their numbers."""
        if not self.size or not len(t.hash):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.searchsorted(self.hash, t.hash)
        hits, numbers = [], []
        for k in range(self.tries):
            x = np.minimum(at + k, self.size - 1)
            hit = np.flatnonzero((self.hash[x] == t.hash) & (self.length[x] == t.end - t.start) & (at + k < self.size))
            x = x[hit]
            hit, x = self._equal(t, hit, x)
            hits.append(hit)
            numbers.append(self.number[x])
        return np.concatenate(hits), np.concatenate(numbers)

    def _equal(self, t: Terms, hit: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those whose bytes are equal, compared eight at a time at most."""
        same = np.ones(len(hit), bool)
        length, a, b = self.length[x], t.start[hit], self.start[x]
        k = 0
        todo = np.arange(len(hit))
        while len(todo):
            same[todo] &= t.buf[a[todo] + k] == self.buf[b[todo] + k]
            k += 1
            todo = todo[(length[todo] > k) & same[todo]]
        return hit[same], x[same]


def _item_terms(items: DataFrame) -> DataFrame:
    """The distinct terms of the items: (term)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in small_blocks(batches):
            t = Terms(block)
            raw = t.buf.tobytes()
            shown = {raw[i:j] for i, j in zip(t.start.tolist(), t.end.tolist())}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(shown), pa.binary())], names=["term"])

    return items.mapInArrow(run, "term binary").distinct()


def _postings(t: Terms, v: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted by (term, document): terms, documents and occurrences."""
    hit, number = v.find(t)
    n_docs = len(t.count)
    key, tf = np.unique(number * n_docs + t.doc[hit], return_counts=True)
    return key // max(1, n_docs), key % max(1, n_docs), tf


POSTINGS = "block long, owner int, terms array<int>, dfs array<int>, n_terms long, n_docs long, body binary"


def _write_postings(docs: DataFrame, vocabulary, owners: int, base: int) -> DataFrame:
    """For each block of documents a row with its documents (owner -1: ids,
    null ids, term counts) and one for each owner with postings in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(vocabulary.value)
        part, serial = TaskContext.get().partitionId(), 0
        held: list = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, size, serial
            ids, null, count = (np.concatenate([h[k] for h in held]) for k in range(3))
            term, doc, tf = (np.concatenate([h[k] for h in held]) for k in range(3, 6))
            order = np.lexsort((doc, term))
            term, doc, tf = term[order], doc[order], tf[order]
            block = (part << 32) | serial
            rows = [(block, -1, [], [], int(count.sum()), int((count > 0).sum()), pack_arrays(ids, null, count))]
            for k in range(owners):
                mine = term % owners == k
                if mine.any():
                    used, df = np.unique(term[mine], return_counts=True)
                    body = pack_arrays(used, df, doc[mine].astype(np.uint16), tf[mine].astype(np.int32))
                    rows.append((block, base + k, used.tolist(), df.tolist(), 0, 0, body))
            held, size, serial = [], 0, serial + 1
            kinds = [pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.binary()]
            names = [c.split()[0] for c in POSTINGS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for b in batches:
            for lo in range(0, b.num_rows, BLOCK_DOCS):
                for block in small_blocks([b.slice(lo, BLOCK_DOCS)]):
                    if size + len(block) > BLOCK_DOCS:
                        yield flush()
                    t = Terms(block)
                    term, doc, tf = _postings(t, v)
                    held.append((block.ids, block.id_null, t.count, term, doc + size, tf))
                    size += len(block)
        if held:
            yield flush()

    return docs.mapInArrow(run, POSTINGS)


def _item_postings(items: DataFrame, vocabulary, owners: int, base: int, groups: int) -> DataFrame:
    """(grp, item_id, owner, term, tf) for the items' terms of one slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(vocabulary.value)
        for block in small_blocks(batches):
            term, doc, tf = _postings(Terms(block), v)
            ids = pa.array(block.ids[doc], pa.int64(), mask=block.id_null[doc])
            owner = pa.array(base + term % owners, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [ids, owner, pa.array(term, pa.int32()), pa.array(tf, pa.int64())], names=["item_id", "owner", "term", "tf"]
            )

    found = items.mapInArrow(run, "item_id long, owner int, term int, tf long")
    return found.withColumn("grp", F.pmod(F.xxhash64("item_id"), F.lit(groups)).cast("int"))


def _bundle_terms(key: tuple, rows: pa.Table) -> pa.Table:
    """What the items of a group ask of each owner: the term, the place of the
    item among the group's, and its weight there."""
    ids = rows["item_id"].to_numpy(zero_copy_only=False) if not rows["item_id"].null_count else None
    listed = rows["item_id"].to_pylist()
    known = sorted({i for i in listed if i is not None}) + ([None] if ids is None else [])
    place_of = {i: k for k, i in enumerate(known)}
    place = np.array([place_of[i] for i in listed], np.int32)
    owner, term = rows["owner"].to_numpy(), rows["term"].to_numpy()
    weight = rows["weight"].to_numpy()
    out = []
    names = pack_arrays(np.array([i or 0 for i in known], np.int64), np.array([i is None for i in known], np.bool_))
    for k in np.unique(owner).tolist():
        m = np.flatnonzero(owner == k)
        m = m[np.lexsort((place[m], term[m]))]
        out.append((key[0].as_py(), k, names, pack_arrays(term[m], place[m], weight[m])))
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.table([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["grp", "owner", "items", "needs"])


BUNDLE = "block long, grp int, docs binary, items binary, held binary"


def _owner_stage(n_docs: int, n_terms: int):
    """One owner's work on one bundle: add its contributions, pass it on."""

    def step(key: tuple, bundles: pa.Table, postings: pa.Table) -> pa.Table:
        if not postings.num_rows or not bundles.num_rows:
            return bundles
        row = bundles.slice(0, 1).to_pylist()[0]
        _, _, count = unpack_arrays(row["docs"])
        m = 75 + (25 * count.astype(np.int64) * n_docs) // n_terms
        scores: dict[int, np.ndarray] = {}
        if row["held"]:
            place, ends, doc, score = unpack_arrays(row["held"])
            for p, lo, hi in zip(place.tolist(), [0, *ends[:-1].tolist()], ends.tolist()):
                scores[p] = np.zeros(len(count), np.int64)
                scores[p][doc[lo:hi]] = score[lo:hi]
        for post in postings.to_pylist():
            row["items"] = post["items"]
            used, df, doc, tf = unpack_arrays(post["body"])
            doc = doc.astype(np.int64)
            tf = tf.astype(np.int64)
            value = (1_000_000_000 * tf) // (1000 * tf + 12 * m[doc])
            ends = np.cumsum(df)
            term, place, weight = unpack_arrays(post["needs"])
            at = np.searchsorted(used, term)
            hit = np.flatnonzero(used[np.minimum(at, len(used) - 1)] == term)
            for p, w, x in zip(place[hit].tolist(), weight[hit].tolist(), at[hit].tolist()):
                lo, hi = ends[x] - df[x], ends[x]
                if p not in scores:
                    scores[p] = np.zeros(len(count), np.int64)
                scores[p][doc[lo:hi]] += w * value[lo:hi]
        kept = [(p, np.flatnonzero(scores[p])) for p in sorted(scores)]
        held = pack_arrays(
            np.array([p for p, _ in kept], np.int32),
            np.cumsum([len(d) for _, d in kept]).astype(np.int64),
            np.concatenate([d for _, d in kept] or [np.zeros(0)]).astype(np.uint16),
            np.concatenate([scores[p][d] for p, d in kept] or [np.zeros(0)]).astype(np.int64),
        )
        cols = [pa.array([row["block"]], pa.int64()), pa.array([row["grp"]], pa.int32())]
        cols += [pa.array([x], pa.binary()) for x in (row["docs"], row["items"], held)]
        return pa.table(cols, names=[c.split()[0] for c in BUNDLE.split(", ")])

    return step


def _best_of_bundles(top: int):
    """Each item's best documents of one block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            if not row["held"]:
                continue
            place, ends, doc, score = unpack_arrays(row["held"])
            ids, null, _ = unpack_arrays(row["docs"])
            item, item_null = unpack_arrays(row["items"])
            out: list[list] = [[], [], []]
            for p, lo, hi in zip(place.tolist(), [0, *ends[:-1].tolist()], ends.tolist()):
                d, s = doc[lo:hi], score[lo:hi]
                if len(s) > top:  # only those that reach the last place, ties included
                    some = np.flatnonzero(s >= np.partition(s, len(s) - top)[len(s) - top])
                    d, s = d[some], s[some]
                d, s = d[s > 0], s[s > 0]
                best = np.lexsort((ids[d], null[d], -s))[:top]
                out[0] += [None if item_null[p] else int(item[p])] * len(best)
                out[1] += [None if null[x] else int(ids[x]) for x in d[best]]
                out[2] += s[best].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["item_id", "doc_id", "score"])

    return run


def search(docs: DataFrame, items: DataFrame, top: int = TOP, owners: int = OWNERS, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Each item's `top` documents: item_id, rank, doc_id, score. `docs` has
    doc_id and text, `items` has item_id and text."""
    spark = docs.sparkSession
    docs = id_and_text(docs)
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    items = stage(items, "search-items")
    terms = stage(_item_terms(items), "search-terms")
    size = sums(terms, n=F.sum(F.length("term") + 16))["n"]
    n_slices = max(1, -(-size // slice_bytes))
    groups = max(1, -(-items.select("item_id").distinct().count() // GROUP_ITEMS))

    postings, needs = [], []
    for k in range(n_slices):
        # one slice of the items' terms at a time, bounded by slice_bytes
        mine = terms.filter(F.pmod(F.xxhash64("term"), F.lit(n_slices)) == k)
        vocabulary = spark.sparkContext.broadcast(sorted(bytes(r[0]) for r in mine.collect()))
        written = _write_postings(docs, vocabulary, owners, k * owners)
        postings.append(stage(written if not k else written.filter("owner >= 0"), "search-postings"))
        needs.append(_item_postings(items, vocabulary, owners, k * owners, groups))

    first = postings[0].filter("owner = -1")
    n = sums(first, docs=F.sum("n_docs"), terms=F.sum("n_terms"))
    weights, wanted = None, None
    for p, need in zip(postings, needs):
        each = p.filter("owner >= 0").select("owner", F.explode(F.arrays_zip("terms", "dfs")).alias("x"))
        df = each.groupBy("owner", F.col("x.terms").alias("term")).agg(F.sum("x.dfs").alias("df"))
        ln = F.log((F.lit(2 * n["docs"] + 2).cast("double")) / (2 * F.col("df") + 1).cast("double"))
        df = df.select("owner", "term", F.floor(1000 * ln).cast("long").alias("w"))
        weights = df if weights is None else weights.unionByName(df)
        wanted = need if wanted is None else wanted.unionByName(need)
    wanted = wanted.join(weights, ["owner", "term"]).select("grp", "item_id", "owner", "term", (F.col("tf") * F.col("w")).alias("weight"))
    wanted = wanted.filter("weight > 0").groupBy("grp").applyInArrow(_bundle_terms, "grp int, owner int, items binary, needs binary")
    wanted = stage(wanted, "search-needs")

    none = F.lit(None).cast("binary")
    every = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    bundles = first.select("block", every.alias("grp"), F.col("body").alias("docs"), none.alias("items"), none.alias("held"))
    step = _owner_stage(n["docs"], max(1, n["terms"]))
    for k in range(n_slices * owners):
        mine = postings[k // owners].filter(F.col("owner") == k).select("block", "owner", "body")
        mine = mine.join(wanted, "owner").select(F.col("block").alias("at_block"), F.col("grp").alias("for_grp"), "items", "needs", "body")
        bundles = bundles.groupBy("block", "grp").cogroup(mine.groupBy("at_block", "for_grp")).applyInArrow(step, BUNDLE)
    best = bundles.mapInArrow(_best_of_bundles(top), "item_id long, doc_id long, score long")
    w = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return best.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item's 20 best documents: item_id, rank, doc_id, score."""
    return search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

OP13_SQL = f"""
with d as (
  select row_number() over () as r, doc_id, regexp_extract_all(text, '{_TERM}') as ts from documents where text is not null
), dt as (
  select r, translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from (select r, unnest(ts) as t from d)
), it as (
  select item_id, translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from (select item_id, unnest(regexp_extract_all(text, '{_TERM}')) as t
        from (select distinct item_id, text from benchmark where text is not null))
), itf as (select item_id, t, count(*) as k from it group by all),
total as (select count(*) filter (len(ts) > 0) as n, sum(len(ts))::bigint as l from d),
tf as (select r, t, count(*) as f from dt where t in (select t from itf) group by all),
w as (
  select t, floor(1000 * ln((2 * (select n from total) + 2)::double / (2 * count(*) + 1)::double))::bigint as w from tf group by t
), m as (
  select r, doc_id, 75 + (25 * len(ts)::bigint * (select n from total)) // (select l from total) as m from d where len(ts) > 0
), s as (
  select itf.item_id, r, sum(itf.k * w.w * ((1000000000 * tf.f) // (1000 * tf.f + 12 * m.m)))::bigint as score
  from itf join tf using (t) join w using (t) join m using (r) group by all
), ranked as (
  select s.item_id, m.doc_id, s.score,
    row_number() over (partition by s.item_id order by s.score desc, m.doc_id asc nulls last) as rank
  from s join m using (r) where s.score > 0
)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= {TOP}
"""
