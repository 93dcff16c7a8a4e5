"""Suffix-array dedup of bytes by a common-prefix-aware merge sort.

A byte is removed when a 400-byte string over it also starts anywhere else.
The sorted suffixes are those that begin at anchors (see `repeats`): equal
400-byte strings have anchors at equal offsets, so two strings are equal
exactly where two anchors' suffixes share F bytes forwards and B bytes
backwards with F + B >= 400. Contexts that are equal as a whole are merged
before anything is sent and settle themselves; a context that no other may
match is not sent.

Each task sorts its contexts (suffix of 400 bytes, then what stands before the
anchor, backwards), front-codes the runs (common prefix with the string before,
and the rest) and sends each part its piece. A part combines its runs with a
loser tree that keeps, with every run's head, its common prefix with the last
winner: two heads are compared by those lengths alone where they differ, and
otherwise only beyond them. Where neighbours share the first 145 bytes they
form a group; its longest matches come from joining neighbours by falling
common prefix, the smaller side into the larger, in order of the bytes before
the anchor, where only neighbours can be the best match.

Defined cases: null and empty texts have no bytes; matches never cross
documents; repeated rows match each other; a null doc_id stays null; a text of
under 400 bytes keeps all, and one of any length is hashed in pieces; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recurra.llm.common import Block, documents, pack_arrays, rows_of, unpack_arrays
from recurra.llm.repeats import HOT, Finder, Seq, _part, _split, cover_mask, covered_blocks

LENGTH = 400
SPREAD = 256
GRAM = 8
PAD = b"\xff"  # in no UTF-8 text: ends a suffix at its document's end
SCHEMA = "doc_id long, text binary, n_bytes long, n_removed long, n_spans long, kept binary"


def common_prefix(a: bytes, b: bytes, i: int = 0) -> int:
    """Length of the common prefix of `a` and `b`, known to be `i` or more."""
    n = min(len(a), len(b))
    while i + 64 <= n and a[i : i + 64] == b[i : i + 64]:
        i += 64
    m = min(n - i, 64)
    x = int.from_bytes(a[i : i + m], "big") ^ int.from_bytes(b[i : i + m], "big")
    return i + m - (x.bit_length() + 7) // 8


def front_code(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted strings as common prefixes, lengths and the remaining bytes."""
    prefix, rest, last = [], [], b""
    for s in strings:
        n = common_prefix(last, s)
        prefix.append(n)
        rest.append(s[n:])
        last = s
    return np.array(prefix, np.uint16), np.array([len(s) for s in strings], np.uint16), np.frombuffer(b"".join(rest), np.uint8)


def decode(prefix: np.ndarray, size: np.ndarray, rest: np.ndarray) -> Iterator[tuple[bytes, int]]:
    raw, at, last = rest.tobytes(), 0, b""
    for n, m in zip(prefix.tolist(), size.tolist()):
        last = last[:n] + raw[at : at + m - n]
        at += m - n
        yield last, n


def merge_runs(runs: list[Iterator[tuple[bytes, int]]]) -> Iterator[tuple[bytes, int, int]]:
    """(string, common prefix with the string before, run) in sorted order."""
    k = 1 << max(0, (len(runs) - 1).bit_length())
    head: list[bytes | None] = [None] * k
    known = [-1] * k  # common prefix of a head with the last winner that met it; -1: run at its end

    def advance(r: int) -> None:
        got = next(runs[r], None)
        head[r], known[r] = got if got else (None, -1)

    def play(x: int, y: int) -> tuple[int, int]:
        """Winner and loser; the loser then knows its common prefix with the winner."""
        hx, hy = known[x], known[y]
        if hx != hy:
            return (x, y) if hx > hy else (y, x)
        if hx < 0:
            return x, y
        a, b = head[x], head[y]
        n = common_prefix(a, b, hx)
        if a[n : n + 1] <= b[n : n + 1]:
            known[y] = n
            return x, y
        known[x] = n
        return y, x

    loser = [0] * k
    for r in range(len(runs)):
        advance(r)
    level = list(range(k))
    first = k
    while first > 1:  # the first round, from the leaves up
        first //= 2
        up = []
        for i in range(first):
            won, loser[first + i] = play(level[2 * i], level[2 * i + 1])
            up.append(won)
        level = up
    won = level[0]
    while head[won] is not None:
        yield head[won], known[won], won
        advance(won)
        node = (won + k) // 2
        while node:
            won, loser[node] = play(won, loser[node])
            node //= 2


def longest_matches(strings: list[bytes], ends: list[int], shared: list[int], length: int = LENGTH) -> list[tuple[int, int] | None]:
    """For sorted contexts of a group: the most bytes before and after the
    anchor that lie in matches of `length` or more with another context.
    `ends`: bytes of the suffix in its document; `shared`: common prefix with
    the string before."""
    n = len(strings)
    best: list = [None] * n

    def pair(i: int, j: int, after: int, before: int) -> None:
        if after + before >= length:
            for x in (i, j):
                b = best[x]
                best[x] = (before, after) if b is None else (max(b[0], before), max(b[1], after))

    back = [s[length:] for s in strings]
    owner = list(range(n))
    members: list[list[tuple[bytes, int]]] = [[(back[i], i)] for i in range(n)]

    def top(i: int) -> int:
        while owner[i] != i:
            owner[i] = owner[owner[i]]
            i = owner[i]
        return i

    for i in sorted(range(1, n), key=lambda i: -min(shared[i], length)):
        after = min(shared[i], length, ends[i], ends[i - 1])
        x, y = top(i - 1), top(i)
        if len(members[x]) < len(members[y]):
            x, y = y, x
        large = members[x]
        for item in members[y]:
            at = bisect_left(large, item)
            for near in large[max(0, at - 1) : at + 1]:
                pair(item[1], near[1], after, common_prefix(item[0], near[0]))
            large.insert(at, item)
        members[y] = []
        owner[y] = x
    return best


class _Runs:
    """Contexts of a task, given out as sorted, front-coded runs by part."""

    def __init__(self, parts: int, most: int = 32 << 20):
        self.parts, self.most = parts, most
        self.rows: dict[int, list] = {}
        self.size = 0

    def add(self, block: Block, number: int, more, ids, doc, anchor, lo, hi, group, cover) -> None:
        part = _part(group, self.parts)
        stop = np.minimum(anchor + LENGTH, block.ends[doc])
        raw = block.buf.tobytes()
        for p, d, a, s, e, dup in zip(part.tolist(), doc.tolist(), anchor.tolist(), lo.tolist(), stop.tolist(), cover.tolist()):
            text = raw[a:e].ljust(LENGTH, PAD) + raw[s:a][::-1]
            self.size += len(text) + 150
            self.rows.setdefault(p, []).append((text, number, d, a, e - a, dup))

    def full(self) -> bool:
        return self.size > self.most

    def flush(self) -> Iterator[tuple[int, bytes]]:
        for part in sorted(self.rows):
            rows = sorted(self.rows[part])
            cols = list(zip(*rows))
            yield part, pack_arrays(
                *front_code(cols[0]),
                np.array(cols[1], np.int64),
                np.array(cols[2], np.int32),
                np.array(cols[3], np.int32),
                np.array(cols[4], np.uint16),
                np.array(cols[5], np.uint8),
            )
        self.rows, self.size = {}, 0


def combine(payloads: list[bytes]):
    """Merge a part's runs; ranges of bytes (block, document, start, stop) in matches."""
    runs = [unpack_arrays(x) for x in payloads]
    place = [0] * len(runs)
    out: list[tuple[int, int, int, int]] = []
    strings: list[bytes] = []
    shared: list[int] = []
    who: list[tuple[int, int]] = []

    def settle() -> None:
        if len(strings) > 1:
            ends = [int(runs[r][6][i]) for r, i in who]
            for (r, i), got in zip(who, longest_matches(strings, ends, shared)):
                if got and not runs[r][7][i]:
                    a = int(runs[r][5][i])
                    out.append((int(runs[r][3][i]), int(runs[r][4][i]), a - got[0], a + got[1]))
        strings.clear()
        shared.clear()
        who.clear()

    for text, n, r in merge_runs([decode(*x[:3]) for x in runs]):
        if n < LENGTH - SPREAD + 1:
            settle()
        strings.append(text)
        shared.append(n)
        who.append((r, place[r]))
        place[r] += 1
    settle()
    got = np.array(out, np.int64).reshape(-1, 4)
    return got[:, 0], got[:, 1], got[:, 2], got[:, 3]


def _symbols(block: Block):
    return Seq(block.buf, block.starts, block.ends), None


FINDER = Finder("bytes", LENGTH, SPREAD, GRAM, False, _symbols, _Runs, combine)


def remove_repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, text, n_bytes, n_removed, n_spans and kept of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            block = Block(row)
            gone = cover_mask(row["cover"], len(block.buf))
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            places = list(zip(block.starts.tolist(), block.ends.tolist()))
            kept = [block.buf[i:j][~gone[i:j]].tobytes() for i, j in places]
            yield pa.RecordBatch.from_arrays(
                [
                    block.doc_ids(),
                    pa.array([None if n < 0 else block.text(i) for i, n in enumerate(block.raw_lens.tolist())], pa.binary()),
                    pa.array(block.lens, pa.int64()),
                    pa.array([int(np.count_nonzero(gone[i:j])) for i, j in places], pa.int64()),
                    pa.array([int(np.count_nonzero(begins[i:j])) for i, j in places], pa.int64()),
                    pa.array(kept, pa.binary()),
                ],
                names=["doc_id", "text", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return covered_blocks(docs, FINDER, hot).mapInArrow(run, SCHEMA)


def op1_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is kept of every document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return remove_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


OP1_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), piece AS (
  SELECT doc_id, base, h[2 * base + 1 : 2 * (base + 599)] AS p FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 399, 200)) AS base FROM d WHERE len(h) >= 800)
), win AS (
  SELECT doc_id, base + j AS i, hash(p[2 * j + 1 : 2 * j + 800]) AS k FROM (SELECT doc_id, base, p, unnest(range(least(200, len(p) // 2 - 399))) AS j FROM piece)
), again AS (SELECT k FROM win GROUP BY k HAVING count(*) > 1
), hit AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS last FROM win JOIN again USING (k)
), run AS (SELECT doc_id, i, sum(CAST(last IS NULL OR i > last + 400 AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM hit
), span AS (SELECT doc_id, min(i) AS lo, max(i) + 400 AS hi FROM run GROUP BY doc_id, run
), gap AS (
  SELECT doc_id, lo AS stop, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS start FROM span
  UNION ALL SELECT doc_id, len(h) // 2, coalesce((SELECT max(hi) FROM span WHERE span.doc_id = d.doc_id), 0) FROM d
), kept AS (
  SELECT doc_id, string_agg(h[2 * start + 1 : 2 * stop], '' ORDER BY start) AS h FROM gap JOIN d USING (doc_id) GROUP BY doc_id
), lost AS (SELECT doc_id, sum(hi - lo) AS n, count(*) AS spans FROM span GROUP BY doc_id
)
SELECT doc_id, CAST(len(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(lost.n, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(kept.h)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)
"""
