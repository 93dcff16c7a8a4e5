"""Substring dedup of words by suffix automata of reference shards.

A window is 13 consecutive words of one document; a word is removed when a
window over it also starts in a document with a smaller doc_id. Every document
is reference for those with larger ids, so the reference is as large as the
corpus and no automaton of it could be broadcast whole. It is cut into shards
by content instead: the windows that share an anchor (see `repeats`) meet in
one shard, contexts that are equal are sent once, and a shard holds only
contexts that some other context may match. In a shard, each group's contexts
are streamed in order of doc_id through a suffix automaton of the contexts
before them; a position whose matching statistic is 13 or more ends a removed
window, and only then is the context added to the automaton. Words are
compared as they are.

Defined cases: null and empty texts have no words; a null doc_id is larger
than every other and equal ids never remove each other's words; repeated rows
each get a result; a text with fewer than 13 words keeps all; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recurra.llm.common import Block, Words, block_rows, documents, pack_arrays, rows_of, unpack_arrays
from recurra.llm.repeats import HOT, Finder, Seq, _part, _split, cover_mask, covered_blocks

LENGTH = 13
SCHEMA = "doc_id long, text binary, n_words long, n_removed long, kept binary"


class SuffixAutomaton:
    """Online suffix automaton of several word sequences."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.size = [0]

    def add(self, words: list[bytes]) -> None:
        nxt, link, size = self.next, self.link, self.size
        last = 0
        for w in words:
            q = nxt[last].get(w)
            if q is not None and size[q] == size[last] + 1:
                last = q
                continue
            if q is not None:
                clone = len(size)
                nxt.append(dict(nxt[q]))
                link.append(link[q])
                size.append(size[last] + 1)
                link[q] = clone
                p = last
                while p >= 0 and nxt[p].get(w) == q:
                    nxt[p][w] = clone
                    p = link[p]
                last = clone
                continue
            cur = len(size)
            nxt.append({})
            link.append(0)
            size.append(size[last] + 1)
            p = last
            while p >= 0 and w not in nxt[p]:
                nxt[p][w] = cur
                p = link[p]
            if p >= 0:
                q = nxt[p][w]
                if size[q] == size[p] + 1:
                    link[cur] = q
                else:
                    clone = len(size)
                    nxt.append(dict(nxt[q]))
                    link.append(link[q])
                    size.append(size[p] + 1)
                    link[q] = link[cur] = clone
                    while p >= 0 and nxt[p].get(w) == q:
                        nxt[p][w] = clone
                        p = link[p]
            last = cur

    def matches(self, words: list[bytes], least: int) -> list[int]:
        """Positions where the longest match that ends there has `least` words or more."""
        nxt, link, size = self.next, self.link, self.size
        state = length = 0
        out = []
        for i, w in enumerate(words):
            while state and w not in nxt[state]:
                state = link[state]
                length = size[state]
            q = nxt[state].get(w)
            if q is not None:
                state = q
                length += 1
            else:
                length = 0
            if length >= least:
                out.append(i)
        return out


class _Fragments:
    """Contexts to send, by part of their group."""

    def __init__(self, parts: int, most: int = 16 << 20):
        self.parts, self.most = parts, most
        self.rows: dict[int, list] = {}
        self.size = 0

    def add(self, block: Block, number: int, w: Words, ids, doc, anchor, lo, hi, group, cover) -> None:
        order = np.argsort(group, kind="stable")
        for part, at in _split(_part(group[order], self.parts)):
            k = order[at]
            last = hi[k] + LENGTH - 1
            a, b = w.start[lo[k]], w.end[last]
            text = b"".join([block.buf[i:j].tobytes() + b"\n" for i, j in zip(a.tolist(), b.tolist())])
            self.size += len(text)
            blob = pack_arrays(group[k], ids[doc[k]], doc[k].astype(np.int32), lo[k].astype(np.int32), (b - a).astype(np.int32), np.frombuffer(text, np.uint8), np.array([number]))
            self.rows.setdefault(part, []).append(blob)

    def full(self) -> bool:
        return self.size > self.most

    def flush(self) -> Iterator[tuple[int, bytes]]:
        for part in sorted(self.rows):
            for blob in self.rows[part]:
                yield part, blob
        self.rows, self.size = {}, 0


def compare_in_shard(payloads: list[bytes]):
    """Ranges of words (block, document, start, stop) that some window covers."""
    frags = []
    for blob in payloads:
        group, ids, doc, lo, n, text, number = unpack_arrays(blob)
        raw = text.tobytes()
        end = np.cumsum(n + 1) - 1
        for g, i, d, p, e, m in zip(group.tolist(), ids.tolist(), doc.tolist(), lo.tolist(), end.tolist(), n.tolist()):
            frags.append((g, i, int(number[0]), d, p, raw[e - m : e]))
    frags.sort()
    out: list[tuple[int, int, int, int]] = []
    k = 0
    while k < len(frags):
        j = k
        while j < len(frags) and frags[j][0] == frags[k][0]:
            j += 1
        seen = SuffixAutomaton()
        while k < j:
            same = k
            texts = []
            while k < j and frags[k][1] == frags[same][1]:
                _, _, number, doc, lo, text = frags[k]
                words = text.split()
                texts.append(words)
                if same or len(seen.size) > 1:
                    out += [(number, doc, lo + e - LENGTH + 1, lo + e + 1) for e in seen.matches(words, LENGTH)]
                k += 1
            if k < j:
                for words in texts:
                    seen.add(words)
    got = np.array(out, np.int64).reshape(-1, 4)
    return got[:, 0], got[:, 1], got[:, 2], got[:, 3]


def _symbols(block: Block):
    w = Words(block)
    return Seq(w.hash, w.first[:-1], w.first[1:]), w


FINDER = Finder("words", LENGTH, 8, 6, True, _symbols, _Fragments, compare_in_shard)


def _kept(block: Block, w: Words, gone: np.ndarray) -> list[bytes]:
    """The words left in each document, joined by one space."""
    buf = block.buf.copy()
    buf[w.end] = 32
    n = len(buf) + 1
    edge = np.bincount(w.start[~gone], minlength=n) - np.bincount(w.end[~gone] + 1, minlength=n + 1)[:n]
    keep = np.cumsum(edge[:-1]) > 0
    return [buf[s : e + 1][keep[s : e + 1]].tobytes()[:-1] for s, e in zip(block.starts.tolist(), block.ends.tolist())]


def _removed(w: Words, gone: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(gone)])
    return total[w.first[1:]] - total[w.first[:-1]]


def remove_repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, text, n_words, n_removed and kept (the kept words, UTF-8) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            block = Block(row)
            w = Words(block)
            gone = cover_mask(row["cover"], len(w.start))
            yield pa.RecordBatch.from_arrays(
                [
                    block.doc_ids(),
                    pa.array([None if n < 0 else block.text(i) for i, n in enumerate(block.raw_lens.tolist())], pa.binary()),
                    pa.array(w.count, pa.int64()),
                    pa.array(_removed(w, gone), pa.int64()),
                    pa.array(_kept(block, w, gone), pa.binary()),
                ],
                names=["doc_id", "text", "n_words", "n_removed", "kept"],
            )

    return covered_blocks(docs, FINDER, hot).mapInArrow(run, SCHEMA)


def cut_documents(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """`docs`, all columns, without the repeated words: a text that loses words
    becomes its kept words joined by one space (`n_chars`, if there, follows),
    one that loses none stays as it is, and one that loses all goes."""
    columns, kinds = docs.columns, dict(docs.dtypes)
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("text", F.col("text").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            block = Block(row)
            w = Words(block)
            gone = cover_mask(row["cover"], len(w.start))
            lost = _removed(w, gone)
            kept = _kept(block, w, gone)
            old = [None if n < 0 else block.text(i) for i, n in enumerate(block.raw_lens.tolist())]
            texts = [k if n else t for k, n, t in zip(kept, lost.tolist(), old)]
            new = {"text": pa.array(texts, pa.binary()).cast(pa.string())}
            if kinds.get("n_chars") == "bigint":
                chars = [None if t is None else len(t.decode()) for t in texts]
                new["n_chars"] = pa.array(chars, pa.int64())
            yield block_rows(row, block, (lost == 0) | (lost < w.count), columns, new)

    return covered_blocks(docs, FINDER, hot, carry=True).mapInArrow(run, docs.schema)


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is kept of every document: doc_id, n_words, n_removed, kept_sha256."""
    return remove_repeats(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP2_SQL = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)
), earliest AS (SELECT k, min(doc_id) AS first_id FROM win GROUP BY k
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM win JOIN earliest USING (k) WHERE first_id < doc_id
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d) ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
