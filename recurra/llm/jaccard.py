"""N-gram Jaccard join with adaptive multi-match prefixes, and its classes.

Two documents link when their sets of distinct 5-word shingles (A-Z
lower-cased) have 100 * shared >= 75 * union. The steps:

1. Every block sends its distinct shingle hashes once; parts count in how many
   blocks' distinct sets each occurs and send the counts back.
2. A document of n shingles needs a = ceil(0.75 n) shared ones. Shingles that
   no other document has cannot be shared; with fewer than `a` others it links
   with nothing. Else its shingles are ordered by (count, hash), and its prefix
   for l matches is the first n - a + l. The smaller of two linked documents
   shares at least ceil(6 n / 7) of its shingles, so for it the *head* of that
   prefix, the first n - ceil(6 n / 7) + l, is enough: the head of the smaller
   and the prefix of the larger share at least min(l, l') shingles (of equal
   sizes, both heads). l is chosen by estimated candidate cost: a longer prefix
   reads more lists, but more shared shingles are asked for before a pair is
   verified.
3. Equal sets are one node. Parts get the prefixes by shingle. Short lists, and
   those in few members' heads, give pairs, which are counted over all shingles
   and verified when they reach l; a list in nobody's head gives none (a
   passage that many documents share, but too little of each to link them).
   Of any other list (near copies by the thousand) only the pairs with its hub,
   the member with the fewest shingles of its own, are verified. Members linked
   with the hub are in one class already. For two others, neither of which is
   linked with the hub or only one, two bounds say what they can share:
   |x & y| <= min(|x & c|, |y & c|) + min(rest of x, rest of y), and the bits in
   which their parity sketches differ, which are at most the shingles that only
   one of them has. Pairs that pass both are verified, so no link is lost. The
   bounds are tested on the pairs of an open member and a member of its hub of
   nearly its size: narrow rows, but still pairs.
4. Verified links become classes by label propagation with pointer jumping.

Defined cases: null, empty and blank texts have no shingles and link with
nothing; a text of fewer than five words has one, its whole word sequence;
repeated rows and equal sets link; a null doc_id takes part, but names no class
(a class without any id has a null component); an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recurra.llm.common import (
    Block,
    Words,
    block_rows,
    corpus_blocks,
    delta,
    documents,
    mix,
    ngram_hashes,
    pack_arrays,
    rows_of,
    stage,
    sums,
    undelta,
    unpack_arrays,
)
from recurra.llm.decontamination import WORDS, shingle_sql

SHINGLE = 5
PERCENT = 75
SHORT = 8
MOST_MATCHES = 8
HEADS = 2
HOT_CLASSES = 1000
SKETCH = 16  # 64-bit words of a parity sketch
U64 = np.uint64


def needed(n):
    """Shingles a document of n must share with any it links with."""
    return -(-PERCENT * n // 100)


def needed_of_smaller(n):
    """Shingles a document of n must share with any it links with that has as
    many or more."""
    return -(-2 * PERCENT * n // (100 + PERCENT))


def sketch(token: np.ndarray) -> np.ndarray:
    """Parity of how many shingles fall on each bit: two sets' sketches differ
    in at most as many bits as there are shingles that only one of them has."""
    odd = np.bincount((token & U64(64 * SKETCH - 1)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


class Sets:
    """Distinct shingles of a block's documents: `token`/`doc`, ordered by
    document and hash, `n` of each document and a 64-bit `key` of its set."""

    def __init__(self, block: Block):
        w = Words(block, lower=True)
        h = ngram_hashes(w.hash, SHINGLE)
        doc = w.doc[: len(h)]
        inside = np.arange(len(h)) + SHINGLE <= w.first[doc + 1]
        tokens, docs = [h[inside]], [doc[inside]]
        few = np.flatnonzero((w.count > 0) & (w.count < SHINGLE))
        for d in few.tolist():
            tokens.append(ngram_hashes(w.hash[w.first[d] : w.first[d + 1]], int(w.count[d])))
            docs.append(np.array([d]))
        token, doc = np.concatenate(tokens), np.concatenate(docs)
        order = np.lexsort((token, doc))
        token, doc = token[order], doc[order]
        new = np.concatenate([[True], (token[1:] != token[:-1]) | (doc[1:] != doc[:-1])]) if len(token) else np.empty(0, bool)
        self.token, self.doc = token[new], doc[new]
        self.n = np.bincount(self.doc, minlength=len(block))
        self.first = np.concatenate([[0], np.cumsum(self.n)])
        acc = np.concatenate([np.zeros(1, U64), np.cumsum(mix(self.token ^ U64(0x5851F42D4C957F2D)), dtype=U64)])
        self.key = mix((acc[self.first[1:]] - acc[self.first[:-1]]) ^ (self.n.astype(U64) << U64(40)))


def _token_ids(token: np.ndarray, bits: int) -> np.ndarray:
    return token >> U64(64 - bits)


def _parts_of(ids: np.ndarray, bits: int, parts: int) -> np.ndarray:
    return ((ids >> U64(max(0, bits - 32))) * U64(parts) >> U64(min(bits, 32))).astype(np.int64)


def _cuts(part: np.ndarray, parts: int) -> np.ndarray:
    return np.searchsorted(part, np.arange(parts + 1))


def _matches(count: np.ndarray, base: int, need: int, n: int) -> int:
    """How many shared prefix shingles to ask for. `count`: of the document's
    shareable shingles in order; `base`: the prefix for one match. Lists read,
    and lists read per match asked for, weighed by the cost of a verification."""
    most = min(MOST_MATCHES, need, len(count) - base + 1)
    if most <= 1:
        return 1
    read = np.cumsum(count[: base + most - 1].astype(float))[base - 1 :]
    ask = np.arange(1, most + 1)
    return int(np.argmin(read * (1 + (n / 16) / ask))) + 1


def shingle_links(blocks: DataFrame, part_tokens: int = 3_000_000) -> tuple[DataFrame, DataFrame]:
    """(block, place, doc_id, n_shingles, key) of every document of the corpus
    blocks, and the links (x, y) between set keys that join the classes."""
    columns = ["block", "n", "n_bytes", "ids", "id_null", "lens", "body"]
    words = sums(blocks, w=F.sum("n_words"))["w"]
    parts = max(1, -(-words // part_tokens))
    bits = min(64, max(32, int(words).bit_length() + 13))

    def send_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            s = Sets(Block(row))
            _, one = np.unique(s.key, return_index=True)  # equal sets of a block count once
            ids, count = np.unique(_token_ids(s.token[np.isin(s.doc, one)], bits), return_counts=True)
            cut = _cuts(_parts_of(ids, bits, parts), parts)
            for p in range(parts):
                if cut[p + 1] > cut[p]:
                    at = slice(cut[p], cut[p + 1])
                    blob = pack_arrays(_small(delta(ids[at])), np.minimum(count[at], 65535).astype(np.uint16))
                    yield pa.RecordBatch.from_pydict({"part": [p], "block": [row["block"]], "payload": [blob]})

    def count_tokens(key: tuple[pa.Scalar, ...], sent: pa.Table) -> pa.Table:
        got = [unpack_arrays(x.as_py()) for x in sent["payload"]]
        size = [len(x[0]) for x in got]
        ids = np.concatenate([undelta(x[0].astype(U64)) for x in got])
        order = np.argsort(ids, kind="stable")
        new = np.concatenate([[True], ids[order][1:] != ids[order][:-1]])
        total = np.add.reduceat(np.concatenate([x[1] for x in got]).astype(np.int64)[order], np.flatnonzero(new))
        count = np.empty(len(ids), np.uint16)
        count[order] = np.minimum(total, 65535)[np.cumsum(new) - 1]
        out = [pack_arrays(c) for c in np.split(count, np.cumsum(size)[:-1])]
        return pa.table({"block": sent["block"], "part": sent["part"], "counts": pa.array(out, pa.binary())})

    sent = blocks.select(*columns).mapInArrow(send_tokens, "part long, block long, payload binary")
    counts = sent.groupBy("part").applyInArrow(count_tokens, "block long, part long, counts binary")
    counts = counts.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("part", "counts"))).alias("counts"))

    def send_prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            block = Block(row)
            s = Sets(block)
            yield _found(0, row["block"], [pack_arrays(block.ids, block.id_null.astype(np.uint8), s.n, s.key)])
            if not row["counts"]:
                continue
            _, one = np.unique(s.key, return_index=True)
            ids = _token_ids(s.token, bits)
            known = np.unique(ids[np.isin(s.doc, one)])
            count = np.concatenate([unpack_arrays(x["counts"])[0] for x in row["counts"]]).astype(np.int64)
            count = count[np.searchsorted(known, ids)]
            out: list = []
            sets_: list = []
            for d in one.tolist():
                n = int(s.n[d])
                at = slice(s.first[d], s.first[d + 1])
                c = count[at]
                common = np.flatnonzero(c >= 2)
                need = needed(n)
                if not n or len(common) < need:
                    continue
                order = common[np.lexsort((s.token[at][common], c[common]))]
                ask = _matches(c[order], len(order) - need + 1, need, n)
                prefix = s.token[at][order[: len(order) - need + ask]]
                least = needed_of_smaller(n)
                head = len(order) - least + ask if len(order) >= least else 0
                out.append((prefix, s.key[d], n, len(common), ask, np.arange(len(prefix)) < head))
                sets_.append((int(s.key[d].view(np.int64)), pack_arrays(delta(s.token[at] >> U64(16))), n, len(common)))
            if out:
                ident, blob, n_, m_ = (list(c) for c in zip(*sets_))
                yield _found(1, ident, blob, n_, m_)
                size = [len(x[0]) for x in out]
                token = np.concatenate([x[0] for x in out])
                more = [np.repeat(np.array([x[k] for x in out], t), size) for k, t in ((1, U64), (2, np.int32), (3, np.int32), (4, np.uint8))]
                more.append(np.concatenate([x[5] for x in out]).astype(np.uint8))
                order = np.argsort(token, kind="stable")
                token, more = token[order], [m[order] for m in more]
                cut = _cuts(_parts_of(token, 64, parts), parts)
                for p in range(parts):
                    if cut[p + 1] > cut[p]:
                        a = slice(cut[p], cut[p + 1])
                        yield _found(2, p, [pack_arrays(delta(token[a]), *[m[a] for m in more])])

    found = stage(
        blocks.select(*columns).join(counts, "block", "left").mapInArrow(send_prefixes, "kind int, id long, payload binary, n long, m long"),
        "jaccard-sets",
        "uncompressed",
    )

    def read_docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            ids, null, n, key = unpack_arrays(row["payload"])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(n), row["id"]), pa.int64()),
                    pa.array(np.arange(len(n)), pa.int64()),
                    pa.array(ids, pa.int64(), mask=null.astype(bool)),
                    pa.array(n, pa.int64()),
                    pa.array(key.view(np.int64), pa.int64()),
                ],
                names=["block", "place", "doc_id", "n_shingles", "key"],
            )

    def read_lists(key: tuple[pa.Scalar, ...], sent: pa.Table) -> pa.Table:
        got = [unpack_arrays(x.as_py()) for x in sent["payload"]]
        token = np.concatenate([undelta(x[0]) for x in got])
        node, n, m, ask, head = (np.concatenate([x[k] for x in got]) for k in (1, 2, 3, 4, 5))
        x, y, shared, ask, hub, head = pairs_of_lists(token, node, n.astype(np.int64), m.astype(np.int64), ask, head.astype(bool))
        return pa.table({"x": x.view(np.int64), "y": y.view(np.int64), "shared": shared, "ask": ask, "hub": hub, "head": head})

    doc_keys = found.filter("kind = 0").select("id", "payload").mapInArrow(
        read_docs, "block long, place long, doc_id long, n_shingles long, key long"
    )
    sets = found.filter("kind = 1").groupBy(F.col("id").alias("key")).agg(*[F.first(c).alias(c) for c in ("payload", "n", "m")])
    pairs = stage(
        found.filter("kind = 2").select(F.col("id").alias("part"), "payload").groupBy("part")
        .applyInArrow(read_lists, "x long, y long, shared long, ask long, hub boolean, head boolean"),
        "jaccard-pairs",
    )
    spokes = pairs.filter("hub").groupBy("x", "y").agg(F.max("head").alias("head"))
    hubs = stage(verify(spokes, sets, sketches=True), "jaccard-hubs")
    linked = _links()
    direct = pairs.filter("NOT hub").groupBy("x", "y").agg(F.sum("shared").alias("s"), F.first("ask").alias("ask")).filter("s >= ask")
    open_pairs = stage(direct.select("x", "y").unionByName(further_pairs(hubs)).distinct(), "jaccard-open")
    other = verify(open_pairs.withColumn("head", F.lit(True)), sets)
    links = hubs.filter(linked).select("x", "y").unionByName(other.filter(linked).select("x", "y"))
    return doc_keys, stage(links, "jaccard-links")


def _small(d: np.ndarray) -> np.ndarray:
    return d.astype(np.uint32) if not len(d) or int(d.max()) < 1 << 32 else d


def _found(kind: int, ident, payload: list, n=0, m=0) -> pa.RecordBatch:
    rows = len(payload)
    each = lambda v: v if isinstance(v, list) else [v] * rows
    return pa.RecordBatch.from_arrays(
        [pa.array([kind] * rows, pa.int32()), pa.array(each(ident), pa.int64()), pa.array(payload, pa.binary()), pa.array(each(n), pa.int64()), pa.array(each(m), pa.int64())],
        names=["kind", "id", "payload", "n", "m"],
    )


def _links():
    return F.col("shared") * (100 + PERCENT) >= PERCENT * (F.col("n_x") + F.col("n_y"))


def further_pairs(hubs: DataFrame) -> DataFrame:
    """(x, y) of the members of one hub, not both linked with it, that the hub
    and their sketches leave open. `hubs`: verified (member, hub) pairs."""
    # sizes of linked sets lie in one class of this width or in neighbours
    size_class = F.floor(F.log("n_x") / float(np.log(100 / PERCENT)))
    state = hubs.withColumn("open", ~_links()).withColumn("c", size_class)
    a = state.filter("open").alias("a")
    b = state.withColumn("c", F.explode(F.array(F.col("c") - 1, F.col("c"), F.col("c") + 1))).alias("b")
    size = F.col("a.n_x") + F.col("b.n_x")
    shares = F.least("a.shared", "b.shared") + F.least(F.col("a.m_x") - F.col("a.shared"), F.col("b.m_x") - F.col("b.shared"))
    differ = sum((F.bit_count(F.col(f"a.s{k}").bitwiseXOR(F.col(f"b.s{k}"))) for k in range(1, SKETCH)), F.bit_count(F.col("a.s0").bitwiseXOR(F.col("b.s0"))))
    fits = (
        (F.col("a.y") == F.col("b.y"))
        & (F.col("a.c") == F.col("b.c"))
        & (~F.col("b.open") | (F.col("a.x") < F.col("b.x")))
        & (F.col("a.head") | (F.col("a.n_x") > F.col("b.n_x")))
        & (F.col("b.head") | (F.col("b.n_x") > F.col("a.n_x")))
        & (shares * (100 + PERCENT) >= PERCENT * size)
        & (differ * (100 + PERCENT) <= (100 - PERCENT) * size)
    )
    return a.join(b, fits).select(F.least("a.x", "b.x").alias("x"), F.greatest("a.x", "b.x").alias("y"))


def pairs_of_lists(token, node, n, m, ask, head):
    """Pairs of short lists and of those in few heads (x < y, with how many lists
    they share and how many they must), and (member, hub) pairs of the others
    (`head`: the list is in the member's head)."""
    order = np.lexsort((node, token))
    token, node, n, m, ask, head = token[order], node[order], n[order], m[order], ask[order], head[order]
    new = np.concatenate([[True], (token[1:] != token[:-1]) | (node[1:] != node[:-1])]) if len(token) else np.empty(0, bool)
    token, node, n, m, ask, head = token[new], node[new], n[new], m[new], ask[new].astype(np.int64), head[new]
    start = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]])) if len(token) else np.empty(0, np.int64)
    size = np.diff(np.concatenate([start, [len(token)]]))
    heads = np.add.reduceat(head.astype(np.int64), start) if len(token) else np.empty(0, np.int64)
    left, right = [], []
    for k in np.flatnonzero((size > SHORT) & (heads > 0) & (heads <= HEADS)).tolist():
        every = np.arange(start[k], start[k] + size[k])
        for one in every[head[every]].tolist():
            others = every[~head[every] | (every > one)]
            left.append(np.minimum(one, others))
            right.append(np.maximum(one, others))
    for k in range(2, SHORT + 1):
        base = start[size == k]
        for i in range(k):
            for j in range(i + 1, k):
                left.append(base + i)
                right.append(base + j)
    i, j = (np.concatenate([np.empty(0, np.int64), *side]) for side in (left, right))
    fits = 100 * np.minimum(n[i], n[j]) >= PERCENT * np.maximum(n[i], n[j])
    fits &= (head[i] | (n[i] > n[j])) & (head[j] | (n[j] > n[i]))
    i, j = i[fits], j[fits]
    least = np.minimum(ask[i], ask[j])
    o = np.lexsort((node[j], node[i]))
    x, y, least = node[i][o], node[j][o], least[o]
    first = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])])) if len(x) else np.empty(0, np.int64)
    shared = np.diff(np.concatenate([first, [len(x)]]))
    out = [[x[first]], [y[first]], [shared], [least[first]], [np.zeros(len(first), bool)], [np.ones(len(first), bool)]]
    long = np.flatnonzero((size > SHORT) & (heads > HEADS))
    if len(long):
        member = np.concatenate([np.arange(start[k], start[k] + size[k]) for k in long])
        which = np.repeat(np.arange(len(long)), size[long])
        # others than heads matter to a smaller head of nearly their size only
        in_list = np.concatenate([[0], np.cumsum(size[long])[:-1]])
        low = np.minimum.reduceat(np.where(head[member], n[member], np.iinfo(np.int64).max), in_list)[which]
        high = np.maximum.reduceat(np.where(head[member], n[member], 0), in_list)[which]
        near = head[member] | ((n[member] > low) & (PERCENT * n[member] <= 100 * high))
        member, which = member[near], which[near]
        o = np.lexsort((node[member], (n - m)[member], which))
        hub = member[o][np.flatnonzero(np.concatenate([[True], which[o][1:] != which[o][:-1]]))][which]  # each list keeps its heads
        spoke = np.stack([node[member], node[hub]], axis=1)
        both, at = np.unique(spoke, axis=0, return_inverse=True)
        in_head = np.zeros(len(both), bool)
        np.logical_or.at(in_head, at.reshape(-1), head[member])
        # the hub is a member too, with itself: it bounds what others share with it
        none = np.zeros(len(both), np.int64)
        for c, v in zip(out, (both[:, 0], both[:, 1], none, none, np.ones(len(both), bool), in_head)):
            c.append(v)
    return tuple(np.concatenate(c) for c in out)


def verify(pairs: DataFrame, sets: DataFrame, sketches: bool = False) -> DataFrame:
    """(x, y, head) with their exact number of shared shingles and their sizes,
    and the parity sketch of x if asked for. The set of y travels to each x, so
    a hub's set is copied and its members stay spread."""
    words = [f"s{k}" for k in range(SKETCH if sketches else 0)]
    side = lambda c: sets.select(*[F.col(k).alias(f"{k}_{c}") for k in ("payload", "n", "m")], F.col("key").alias(c))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            xs, ys = b.column(b.schema.get_field_index("payload_x")), b.column(b.schema.get_field_index("payload_y"))
            shared, last, have, parity = [], None, None, None
            bits = []
            for p, q in zip(xs, ys):
                p, q = p.as_py(), q.as_py()
                if p != last:
                    last, have = p, undelta(unpack_arrays(p)[0])
                    parity = sketch(have) if sketches else None
                if sketches:
                    bits.append(parity)
                other = undelta(unpack_arrays(q)[0])
                both = np.concatenate([have, other])
                both.sort()
                shared.append(int((both[1:] == both[:-1]).sum()))
            keep = [b.column(b.schema.get_field_index(c)) for c in ("x", "y", "head", "n_x", "m_x", "n_y")]
            more = [pa.array(np.array([w[k] for w in bits], np.int64), pa.int64()) for k in range(len(words))]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(shared, pa.int64()), *more], names=["x", "y", "head", "n_x", "m_x", "n_y", "shared", *words]
            )

    both = pairs.join(side("y"), "y").join(side("x"), "x")
    schema = "x long, y long, head boolean, n_x long, m_x long, n_y long, shared long" + "".join(f", {w} long" for w in words)
    return both.select("x", "y", "head", "n_x", "m_x", "n_y", "payload_x", "payload_y").mapInArrow(run, schema)


def components(links: DataFrame) -> DataFrame:
    """(key, root) of every node with a link; nodes of a class have one root.
    Labels spread along links, then jump to the label of the node they name."""
    edges = stage(
        links.unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y"))).filter("x <> y").distinct(), "jaccard-edges"
    )
    inside = edges.select(F.col("x").alias("key")).distinct()
    state = stage(inside.select("key", F.col("key").alias("root")), "jaccard-labels")
    while True:
        near = edges.join(state.withColumnRenamed("key", "y"), "y").groupBy(F.col("x").alias("key")).agg(F.min("root").alias("near"))
        step = state.join(near, "key").select("key", F.least("root", "near").alias("root"), (F.col("near") < F.col("root")).alias("moved"))
        step = stage(step, "jaccard-labels")
        if not sums(step, n=F.count(F.when(F.col("moved"), 1)))["n"]:
            break
        jump = step.select(F.col("key").alias("root"), F.col("root").alias("next"))
        state = stage(step.join(jump, "root").select("key", F.least("root", "next").alias("root")), "jaccard-labels")
    return state


def _rooted(blocks: DataFrame) -> DataFrame:
    """Documents with shingles and without, each with its class's root."""
    doc_keys, links = shingle_links(blocks)
    return doc_keys.join(components(links), "key", "left").withColumn("root", F.coalesce("root", "key"))


def jaccard_classes(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every document. The ids of classes
    with more than a thousandth of the documents are broadcast (fewer than
    HOT_CLASSES rows), so that no task gets all documents of such a class."""
    rooted = stage(_rooted(corpus_blocks(docs, "jaccard-blocks")), "jaccard-rooted")
    full = rooted.filter("n_shingles > 0")
    least = stage(full.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("n")), "jaccard-classes")
    total = sums(least, n=F.sum("n"))["n"]
    hot = least.filter(F.col("n") * HOT_CLASSES > total).select("root", F.col("component_id").alias("hot_id"), F.lit(True).alias("hot"))
    full = full.join(F.broadcast(hot), "root", "left")
    # documents of hot classes are done: a key of their own spreads them
    full = full.withColumn("root", F.when(F.col("hot"), F.xxhash64("block", "place")).otherwise(F.col("root")))
    full = full.join(least.select("root", "component_id"), "root", "left")
    component = F.when(F.col("hot"), F.col("hot_id")).otherwise(F.col("component_id")).alias("component_id")
    full = full.select("doc_id", "n_shingles", component)
    return full.unionByName(rooted.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """`docs`, all columns, with one document of each class: the smallest
    doc_id, and the first read of rows that share it. Documents without
    shingles all stay."""
    columns = docs.columns
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("text", F.col("text").cast("string"))
    blocks = corpus_blocks(docs, "jaccard-blocks", carry=True)
    rooted = _rooted(blocks)
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "block", "place")).alias("best")
    stays = rooted.filter("n_shingles > 0").groupBy("root").agg(best).select("best.block", "best.place")
    stays = stays.unionByName(rooted.filter("n_shingles = 0").select("block", "place"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            block = Block(row)
            keep = np.zeros(len(block), bool)
            keep[row["places"]] = True
            yield block_rows(row, block, keep, columns, {})

    return blocks.join(stays.groupBy("block").agg(F.collect_list("place").alias("places")), "block").mapInArrow(run, docs.schema)


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class: doc_id, n_shingles, component_id."""
    return jaccard_classes(documents(spark, sf_dir))


OP9_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, text, least(5, len({WORDS.format(t="coalesce(text, '')")})) AS w_n FROM documents
), sh AS ({shingle_sql("d", "doc_id", "w_n")}
), size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), link AS (
  SELECT x, y FROM (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS s FROM sh a JOIN sh b USING (width, shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL
  ) JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y WHERE 100 * s >= 75 * (p.n + q.n - s)
), reach AS (
  SELECT doc_id, doc_id AS c FROM d UNION SELECT y, c FROM reach JOIN link ON x = doc_id
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, min(c) AS component_id FROM reach LEFT JOIN size USING (doc_id) GROUP BY ALL
"""
