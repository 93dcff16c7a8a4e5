"""Finding windows of a fixed length that occur elsewhere in the corpus.

Shared by the byte and the word operator. The unit is a *context*: the
windows that share a minimizer. In every run of `spread` neighbouring window
starts the position with the smallest k-gram hash is the anchor; equal windows
have their anchors at the same offset, so two equal windows always meet under
the hash of the symbols that follow the anchor in both (`group`). A context is
all windows of one place with one anchor, [lo, hi + length).

Round 1 sends each block's distinct (group, context hash) pairs, compressed,
to the part of the group. A context seen before settles all its windows
without a comparison; groups with several different contexts are told to send
one copy of each (round 2), which the operator compares in its own way. Groups
of more than `hot` contexts go another exact way: their windows, one row each,
through a Spark aggregation by window hash.

What is sent in round 1 is one entry of about 12 bytes for a distinct context
of a block, however often the block repeats it.

A block of over `PIECE` symbols (one long text) is hashed in pieces that overlap
by what a window reaches; contexts cut by a piece's end are put together again,
so any length gives what one pass over all symbols would.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurra.llm.common import (
    _R,
    _R_INV,
    U64,
    Block,
    _powers,
    corpus_blocks,
    delta,
    mix,
    pack_arrays,
    rows_of,
    stage,
    sums,
    undelta,
    unpack_arrays,
)

HOT = 20_000
COVERED, SEND, IS_HOT = 1, 2, 4
_LOW48 = U64((1 << 48) - 1)
_INDEX = U64((1 << 28) - 1)
PIECE = 1 << 22


class Seq:
    """Symbols of a block with constant-time hashes of any range."""

    def __init__(self, values: np.ndarray, first: np.ndarray, last: np.ndarray, piece: int = PIECE):
        """`first`/`last`: where each document's symbols begin and end."""
        self.values, self.n, self.first, self.last, self.piece = values, len(values), first, last, piece
        self.held: tuple = (0, -1, None)

    def sums(self, a: int, b: int) -> np.ndarray:
        """Prefix sums for hashes inside [a, b), counted from `a`."""
        if self.n <= self.piece:
            a, b = 0, self.n
        if self.held[0] != a or self.held[1] < b:
            acc = np.zeros(b - a + 1, U64)
            np.cumsum((self.values[a:b].astype(U64) + U64(1)) * _powers(_R, b - a + 1)[: b - a], dtype=U64, out=acc[1:])
            self.held = (a, b, acc)
        return self.held[2]

    def span(self, lo, hi) -> np.ndarray:
        lo, hi = np.asarray(lo), np.asarray(hi)
        x = np.empty(len(lo), U64)
        which = lo // self.piece if self.n > self.piece else np.zeros(len(lo), np.int64)
        order = np.argsort(which, kind="stable") if self.n > self.piece else np.arange(len(lo))
        for w, at in _split(which[order]):
            at = order[at] if self.n > self.piece else at
            a = w * self.piece
            acc = self.sums(a, int(hi[at].max()))
            x[at] = (acc[hi[at] - a] - acc[lo[at] - a]) * _powers(_R_INV, len(acc))[lo[at] - a]
        return mix(x + (hi - lo).astype(U64) * U64(0xD6E8FEB86659FD93))

    def contexts(self, length: int, spread: int, k: int):
        """Arrays (document, anchor, lo, hi) of all contexts."""
        none = np.empty(0, np.int64)
        got = [self.contexts_from(a, length, spread, k) for a in range(0, self.n, self.piece)]
        doc, anchor, lo, hi = (np.concatenate([none, *x]) for x in zip(*got)) if got else (none,) * 4
        if len(got) < 2 or not len(doc):
            return doc, anchor, lo, hi
        new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])]))
        return doc[new], anchor[new], lo[new], hi[np.concatenate([new[1:], [len(doc)]]) - 1]

    def contexts_from(self, a: int, length: int, spread: int, k: int):
        """The contexts of the windows that start in the piece at `a`."""
        none = np.empty(0, np.int64)
        stop = min(self.n, a + self.piece)
        n = min(self.n, stop + spread + k - 2) - a
        if n - k + 1 - spread + 1 <= 0:
            return none, none, none, none
        acc = self.sums(a, a + n)
        key = mix((acc[k : n + 1] - acc[: n - k + 1]) * _powers(_R_INV, len(acc))[: n - k + 1])
        key &= ~_INDEX
        key |= np.arange(len(key), dtype=U64)
        size = 1
        while size * 2 <= spread:
            key = np.minimum(key[:-size], key[size:])
            size *= 2
        if size < spread:
            key = np.minimum(key[: len(key) - (spread - size)], key[spread - size :])
        at = (key & _INDEX).astype(np.int64)
        # window starts that leave room for a whole window in their document
        first = np.maximum(self.first, a)
        room = np.maximum(np.minimum(self.last - length + 1, stop) - first, 0)
        begin = np.repeat(first, room)
        doc = np.repeat(np.arange(len(first)), room)
        p = begin + np.arange(len(begin)) - np.repeat(np.cumsum(room) - room, room)
        if not len(p):
            return none, none, none, none
        anchor = at[p - a] + a
        new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])]))
        end = np.concatenate([new[1:], [len(p)]]) - 1
        return doc[new], anchor[new], p[new], p[end]


class Finder:
    """One operator's settings. `symbols(block)` gives (Seq, anything more that
    `fragments` needs); `by_doc`: a window counts as repeated only if it starts
    in a document with a smaller id, else if it starts anywhere else."""

    def __init__(self, name: str, length: int, spread: int, k: int, by_doc: bool, symbols: Callable, fragments: Callable, compare: Callable):
        self.piece = PIECE
        if spread + k - 1 > length:
            raise ValueError("the anchor must lie inside the window")
        self.name, self.length, self.spread, self.k, self.by_doc = name, length, spread, k, by_doc
        self.common = length - spread + 1  # symbols after the anchor in all windows of a context
        self.symbols, self.fragments, self.compare = symbols, fragments, compare

    def entries(self, block: Block):
        """Contexts of a block with their group and context hashes (48 bits)."""
        seq, more = self.symbols(block)
        seq.piece = self.piece
        doc, anchor, lo, hi = seq.contexts(self.length, self.spread, self.k)
        group = seq.span(anchor, anchor + self.common) >> U64(16)
        inner = mix((anchor - lo).astype(U64) * U64(1 << 32) + (hi - lo).astype(U64))
        context = mix(seq.span(lo, hi + self.length) ^ inner) & _LOW48
        return seq, more, doc, anchor, lo, hi, group, context


def _doc_keys(block: Block) -> np.ndarray:
    """Ids as sort keys; a null id is larger than any other."""
    return np.where(block.id_null, np.iinfo(np.int64).max, block.ids)


def _entry_key(group: np.ndarray, context: np.ndarray) -> np.ndarray:
    return mix((group << U64(16)) ^ (context * U64(0x9FB21C651E98DF25)))


def _part(group: np.ndarray, parts: int) -> np.ndarray:
    return ((group >> U64(16)) * U64(parts) >> U64(32)).astype(np.int64)


def _split(part: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of equal values in a sorted array."""
    cut = np.flatnonzero(np.diff(part)) + 1
    for i, j in zip([0, *cut.tolist()], [*cut.tolist(), len(part)]):
        if j > i:
            yield int(part[i]), slice(i, j)


def _batch(**cols) -> pa.RecordBatch:
    kinds = {"part": pa.int64(), "block": pa.int64(), "kind": pa.int32(), "payload": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(v, kinds[k]) for k, v in cols.items()], names=list(cols))


def covered_blocks(docs: DataFrame, find: Finder, hot: int = HOT, part_entries: int = 1_500_000, carry: bool = False) -> DataFrame:
    """The corpus as blocks, each with `cover`: payloads of (document, start,
    stop) ranges of symbols to remove."""
    blocks = corpus_blocks(docs, f"{find.name}-blocks", carry=carry)
    size = sums(blocks, b=F.sum("n_words" if find.by_doc else "n_bytes"))["b"]
    parts = max(1, -(-2 * size // ((find.spread + 1) * part_entries)))

    def send_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            block = Block(row)
            _, _, doc, _, _, _, group, context = find.entries(block)
            info = _doc_keys(block)[doc] if find.by_doc else np.ones(len(doc), np.int64)
            order = np.lexsort((context, group))
            group, context, info = group[order], context[order], info[order]
            first = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]) | (context[1:] != context[:-1])])) if len(group) else []
            if not len(first):
                continue
            info = np.minimum.reduceat(info, first) if find.by_doc else np.minimum(np.add.reduceat(info, first), 2)
            group, context = group[first], context[first]
            for part, at in _split(_part(group, parts)):
                c = context[at]
                blob = pack_arrays(delta(group[at]), (c & U64(0xFFFFFFFF)).astype(np.uint32), (c >> U64(32)).astype(np.uint16), info[at])
                yield _batch(part=[part], block=[row["block"]], payload=[blob])

    def judge(key: tuple[pa.Scalar, ...], sent: pa.Table) -> pa.Table:
        block = np.array(sent["block"], np.int64)
        source = np.argsort(block, kind="stable")
        got = [unpack_arrays(sent["payload"][int(i)].as_py()) for i in source]
        src = np.repeat(np.arange(len(got)), [len(x[0]) for x in got])
        group = np.concatenate([undelta(x[0]) for x in got])
        context = np.concatenate([x[1].astype(U64) | (x[2].astype(U64) << U64(32)) for x in got])
        info = np.concatenate([x[3] for x in got])
        order = np.lexsort((src, context, group))
        group, context, info, src = group[order], context[order], info[order], src[order]
        new_g = np.concatenate([[True], group[1:] != group[:-1]])
        new_c = new_g | np.concatenate([[True], context[1:] != context[:-1]])
        cls = np.cumsum(new_c) - 1
        first = np.flatnonzero(new_c)
        per_group = np.bincount(np.cumsum(new_g[first]) - 1)  # contexts in each group
        several = per_group[np.cumsum(new_g) - 1]
        if find.by_doc:
            least = np.minimum.reduceat(info, first)[cls]
            covered, sends = least < info, least == info
        else:
            covered, sends = np.add.reduceat(info, first)[cls] >= 2, new_c
        flag = covered * COVERED + (sends & (several > 1)) * SEND + (several > hot) * IS_HOT
        use = np.flatnonzero(flag & (COVERED | SEND))
        use = use[np.argsort(src[use], kind="stable")]
        key_ = _entry_key(group, context)
        out_block, out_blob = [], []
        for s, at in _split(src[use]):
            out_block.append(int(block[source[s]]))
            k = key_[use[at]]
            o = np.argsort(k)
            out_blob.append(pack_arrays(delta(k[o]), flag[use[at]][o].astype(np.uint8)))
        return pa.table({"block": pa.array(out_block, pa.int64()), "flags": pa.array(out_blob, pa.binary())})

    sent = blocks.select("block", "n", "n_bytes", "ids", "id_null", "lens", "body").mapInArrow(
        send_hashes, "part long, block long, payload binary"
    )
    flags = sent.groupBy("part").applyInArrow(judge, "block long, flags binary").groupBy("block").agg(F.collect_list("flags").alias("flags"))

    def send_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = find.fragments(parts)
        for row in rows_of(batches):
            block = Block(row)
            seq, more, doc, anchor, lo, hi, group, context = find.entries(block)
            entry = _entry_key(group, context)
            flag = np.zeros(len(entry), np.uint8)
            for blob in row["flags"] or []:
                d, f = unpack_arrays(blob)
                k = undelta(d)
                at = np.minimum(np.searchsorted(k, entry), len(k) - 1)
                flag |= np.where(k[at] == entry, f[at], 0).astype(np.uint8)
            ids = _doc_keys(block)
            # contexts repeated inside the block: flags say what other blocks have, this what the block has
            order = np.lexsort((lo, ids[doc], entry))
            new = np.concatenate([[True], entry[order][1:] != entry[order][:-1]]) if len(order) else np.empty(0, bool)
            leader = np.empty(len(order), np.int64)
            leader[order] = order[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(order) else 0
            if find.by_doc:
                local = ids[doc] > ids[doc[leader]]
                lead = ids[doc] == ids[doc[leader]]
            else:
                count = np.bincount(leader, minlength=len(order))[leader]
                local = count >= 2
                lead = leader == np.arange(len(order))
            cover = ((flag & COVERED) > 0) | local
            at = np.flatnonzero(cover)
            if len(at):
                yield _batch(part=[0], block=[row["block"]], kind=[0], payload=[pack_arrays(*_merge(doc[at], lo[at], hi[at] + find.length))])
            send = ((flag & SEND) > 0) & lead
            hot_at = np.flatnonzero(send & ((flag & IS_HOT) > 0))
            if len(hot_at):
                n = hi[hot_at] - lo[hot_at] + 1
                p = np.repeat(lo[hot_at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                d = np.repeat(doc[hot_at], n)
                info = ids[d] if find.by_doc else np.repeat(1 + cover[hot_at].astype(np.int64), n)
                blob = pack_arrays(seq.span(p, p + find.length), info, d, p)
                yield _batch(part=[0], block=[row["block"]], kind=[2], payload=[blob])
            at = np.flatnonzero(send & ((flag & IS_HOT) == 0))
            held.add(block, row["block"], more, ids, doc[at], anchor[at], lo[at], hi[at], group[at], cover[at])
            if held.full():
                yield from (_batch(part=[p], block=[0], kind=[1], payload=[x]) for p, x in held.flush())
        yield from (_batch(part=[p], block=[0], kind=[1], payload=[x]) for p, x in held.flush())

    found = stage(
        blocks.select("block", "n", "n_bytes", "ids", "id_null", "lens", "body")
        .join(flags, "block", "left")
        .mapInArrow(send_contexts, "part long, block long, kind int, payload binary"),
        f"{find.name}-contexts",
        "uncompressed",
    )

    def compare(key: tuple[pa.Scalar, ...], sent: pa.Table) -> pa.Table:
        block, doc, lo, hi = find.compare([x.as_py() for x in sent["payload"]])
        order = np.argsort(block, kind="stable")
        block, doc, lo, hi = block[order], doc[order], lo[order], hi[order]
        out_block, out = [], []
        for b, at in _split(block):
            out_block.append(b)
            out.append(pack_arrays(*_merge(doc[at], lo[at], hi[at])))
        return pa.table({"block": pa.array(out_block, pa.int64()), "cover": pa.array(out, pa.binary())})

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            key, info, doc, p = unpack_arrays(row["payload"])
            yield pa.RecordBatch.from_pydict(
                {"block": pa.array(np.full(len(key), row["block"]), pa.int64()), "key": key.view(np.int64), "info": info, "doc": doc, "p": p}
            )

    def gather(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        doc, p = np.array(rows["doc"], np.int64), np.array(rows["p"], np.int64)
        order = np.lexsort((p, doc))
        blob = pack_arrays(*_merge(doc[order], p[order], p[order] + find.length))
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "cover": pa.array([blob], pa.binary())})

    one = found.filter("kind = 2").select("block", "payload").mapInArrow(windows, "block long, key long, info long, doc long, p long")
    if find.by_doc:
        best = one.groupBy("key").agg(F.min("info").alias("best"))
        again = one.join(best, "key").filter("info > best")
    else:
        best = one.groupBy("key").agg(F.sum("info").alias("best"))
        again = one.join(best, "key").filter("best >= 2")
    cover = (
        found.filter("kind = 0").select("block", F.col("payload").alias("cover"))
        .unionByName(found.filter("kind = 1").groupBy("part").applyInArrow(compare, "block long, cover binary"))
        .unionByName(again.select("block", "doc", "p").groupBy("block").applyInArrow(gather, "block long, cover binary"))
    )
    return blocks.join(cover.groupBy("block").agg(F.collect_list("cover").alias("cover")), "block", "left")


def _merge(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of ranges, per document."""
    order = np.lexsort((lo, doc))
    doc, lo, hi = doc[order], lo[order], hi[order]
    # ranges of later documents lie behind those of earlier ones, so one running maximum serves all
    top = np.maximum.accumulate(hi) if len(hi) else hi
    new = np.concatenate([[True], (lo[1:] > top[:-1]) | (doc[1:] != doc[:-1])]) if len(lo) else np.empty(0, bool)
    at = np.flatnonzero(new)
    end = np.concatenate([at[1:], [len(lo)]]) - 1
    return doc[at].astype(np.int32), lo[at].astype(np.int32), (top[end] if len(at) else hi).astype(np.int32)


def cover_mask(payloads: list | None, n: int) -> np.ndarray:
    """Which of `n` symbols are in any of the ranges."""
    got = [unpack_arrays(blob)[1:] for blob in payloads or []]
    lo, hi = (np.concatenate([np.empty(0, np.int32), *x]) for x in zip(*got)) if got else (np.empty(0, np.int32),) * 2
    _, lo, hi = _merge(np.zeros(len(lo), np.int32), lo, hi)
    edge = np.zeros(n + 1, np.int8)  # the ranges are apart, so a byte a symbol is enough
    edge[lo] = 1
    edge[hi] = -1
    return np.cumsum(edge[:n], dtype=np.int8).view(np.bool_)
