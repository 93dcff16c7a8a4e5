"""Byte-level BPE encoding and decoding with a segment tree over byte positions.

A vocabulary gives byte strings their ranks, which are also their ids. A text
is cut by the vocabulary's pattern and every match is encoded by itself: a
match that is in the vocabulary is one id; otherwise it starts as single bytes,
and the adjacent pair of lowest rank, the leftmost of equals, is merged until
no pair is in the vocabulary. The leaves of a segment tree hold, for the token
that starts at a byte position, the rank of its pair with its right neighbour;
every inner node holds the leftmost least of its two, so the root names the
next merge. A merge ends one token and changes the pairs of two live
neighbours: three point updates of logarithmic cost, so a match of any length
takes n log n steps.

Encoding is a narrow pass. Texts whose spaces are single and stand between two
other characters are cut before each space (the pattern always starts a match
there), and the ids of such words are remembered in each worker up to a bound;
other texts are matched whole. What is remembered never changes a result.

Decoding joins the byte strings of the ids; it gives bytes, since ids cut
anywhere need not be UTF-8.

Defined cases: a null or empty text has no ids and decodes to no bytes;
repeated rows are encoded alike; a null `doc_id` stays null; an empty table
gives no rows; other columns, whatever their names, are ignored. A null list of
ids decodes to no bytes, a null or unknown id in it raises.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recurra.llm.common import documents, id_and_text

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
NO_PAIR, NONE_32 = 1 << 62, np.int32((1 << 31) - 1)
SHORT = 64  # bytes of a match that is merged together with others
ROWS, BYTES = 1024, 4 << 20  # documents and characters encoded at a time

_CODECS: dict = {}  # one per worker and vocabulary


def read_ranks(path: str) -> dict[bytes, int]:
    """Lines of base64 bytes and rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one match, by repeated merges of the leftmost least pair."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n = len(piece)
    rank = ranks.get
    size = 1 << max(0, (n - 2).bit_length())
    last = size - 1  # a leaf's value is rank * size + position
    tree = [NO_PAIR] * (2 * size)
    for i in range(n - 1):
        if (r := rank(piece[i : i + 2])) is not None:
            tree[size + i] = r * size + i
    for x in range(last, 0, -1):
        a, b = tree[2 * x], tree[2 * x + 1]
        tree[x] = a if a < b else b

    def put(leaf: int, value: int) -> None:
        x = size + leaf
        if tree[x] == value:
            return
        tree[x] = value
        while x > 1:
            x >>= 1
            a, b = tree[2 * x], tree[2 * x + 1]
            if b < a:
                a = b
            if tree[x] == a:
                return
            tree[x] = a

    def pair(i: int, end: int) -> int:
        r = rank(piece[i:end])
        return NO_PAIR if r is None else r * size + i

    after = list(range(1, n + 1))  # where the token that starts here ends
    before = list(range(-1, n - 1))  # where the token to its left starts
    while (least := tree[1]) != NO_PAIR:
        i = least & last
        gone = after[i]
        end = after[i] = after[gone]
        if gone < size:
            put(gone, NO_PAIR)
        if end < n:
            before[end] = i
            put(i, pair(i, after[end]))
        else:
            put(i, NO_PAIR)
        if (left := before[i]) >= 0:
            put(left, pair(left, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


class Forest:
    """Merges many short matches at once: one segment tree of `size` leaves for
    each, all trees stepping together. Tokens are known by id, so a pair is
    looked up by its two ids among all splits of a token into two tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        self.base = max(ranks.values()) + 1
        if self.base * SHORT >= NONE_32:
            raise ValueError("the vocabulary is too large for 32-bit trees")
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        found = {}
        for token, r in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    found[a * self.base + b] = r
        self.pairs = np.array(sorted(found), np.int64)
        self.rank = np.array([found[k] for k in self.pairs.tolist()], np.int32)
        first, second = np.divmod(np.arange(1 << 16), 256)
        self.first = self._ranks(self.byte_id[first], self.byte_id[second]).reshape(256, 256)  # of two single bytes

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of tokens, -1 where it is none."""
        keys = left.astype(np.int64) * self.base + right
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        return np.where(self.pairs[at] == keys, self.rank[at], np.int32(-1))

    def merge(self, pieces: list[bytes], size: int, rows: int = 2048) -> list[bytes]:
        """Little-endian ids of matches of 2 to `size` bytes each, `rows` of
        them at a time (what the processor's cache holds)."""
        return [x for k in range(0, len(pieces), rows) for x in self._merge(pieces[k : k + rows], size)]

    def _merge(self, pieces: list[bytes], size: int) -> list[bytes]:
        n_rows, last = len(pieces), size - 1
        n = np.array([len(p) for p in pieces], np.int32)
        raw = np.frombuffer(b"".join([p.ljust(size, b"\0") for p in pieces]), np.uint8).reshape(n_rows, size)
        place = np.arange(size, dtype=np.int32)
        token = self.byte_id[raw]
        live = place < n[:, None]
        after = np.broadcast_to(place + 1, (n_rows, size)).copy()
        before = np.broadcast_to(place - 1, (n_rows, size)).copy()
        tree = np.full((n_rows, 2 * size), NONE_32, np.int32)
        r = self.first[raw[:, :-1], raw[:, 1:]]
        tree[:, size:-1] = np.where((r >= 0) & live[:, 1:], r * size + place[:-1], NONE_32)
        x = size
        while x > 1:
            tree[:, x // 2 : x] = np.minimum(tree[:, x : 2 * x : 2], tree[:, x + 1 : 2 * x : 2])
            x //= 2
        row = np.flatnonzero(tree[:, 1] != NONE_32)
        while len(row):
            least = tree[row, 1]
            i = least & last
            gone = after[row, i]
            end = after[row, gone]
            merged = token[row, i] = least // size
            after[row, i] = end
            live[row, gone] = False
            more = end < n[row]
            right = np.where(more, end, 0)
            before[row[more], end[more]] = i[more]
            r = np.where(more, self._ranks(merged, token[row, right]), -1)
            tree[row, size + i] = np.where(r >= 0, r * size + i, NONE_32)
            tree[row, size + gone] = NONE_32
            left = before[row, i]
            any_left = left >= 0
            left = np.where(any_left, left, i)
            r = self._ranks(token[row, left], merged)
            at = size + left
            tree[row, at] = np.where(any_left, np.where(r >= 0, r * size + left, NONE_32), tree[row, at])
            a, b, c = size + i, size + gone, at
            while a[0] > 1:
                a, b, c = a >> 1, b >> 1, c >> 1
                for x in (a, b, c):
                    tree[row, x] = np.minimum(tree[row, 2 * x], tree[row, 2 * x + 1])
            row = row[tree[row, 1] != NONE_32]
        flat = token[live].astype("<i4").tobytes()
        ends = 4 * np.cumsum(live.sum(1))
        return [flat[i:j] for i, j in zip([0, *ends[:-1].tolist()], ends.tolist())]


class Codec:
    """Ids of texts and bytes of ids, for one vocabulary."""

    def __init__(self, path: str, pattern: str, most: int = 700_000):
        import regex

        self.ranks = read_ranks(path)
        self.forest = Forest(self.ranks)
        self.matches = regex.compile(pattern).findall
        # white space of other kinds, and a space beside any or at an end of the text
        self.odd = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]").search
        self.loose = regex.compile(r"\s \s?| \s|^ | $").search
        self.most = most
        self.first: dict[str, bytes] = {}  # words without a space before them
        self.later: dict[str, bytes] = {}  # words after a space
        self.pieces: dict[str, bytes] = {}
        self.bytes_of = {i: token for token, i in self.ranks.items()}

    def _fill(self, pieces: set[str]) -> None:
        """Remember the ids of matches that are not known yet."""
        by_size: dict[int, list] = {}
        for p in pieces:
            raw = p.encode()
            if (whole := self.ranks.get(raw)) is not None:
                self.pieces[p] = whole.to_bytes(4, "little")
            elif len(raw) > SHORT:
                self.pieces[p] = np.array(merge(raw, self.ranks), "<i4").tobytes()
            else:
                by_size.setdefault(1 << (len(raw) - 1).bit_length(), []).append((p, raw))
        for size, some in by_size.items():
            names, raws = zip(*some)
            self.pieces.update(zip(names, self.forest.merge(list(raws), size)))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        first, later, pieces, matches = self.first, self.later, self.pieces, self.matches
        if len(first) + len(later) + len(pieces) > self.most:
            for known in (first, later, pieces):
                known.clear()
        whole: dict[int, list[str]] = {}
        split: list[list[str]] = []
        firsts: set[str] = set()
        laters: set[str] = set()
        for k, t in enumerate(texts):
            if self._apart(t):
                words = t.split(" ")
                firsts.add(words[0])
                laters.update(words[1:])
            else:
                words, whole[k] = [], matches(t)
            split.append(words)
        new = [(first, w, matches(w)) for w in firsts.difference(first)]
        new += [(later, w, matches(" " + w)) for w in laters.difference(later)]
        found = {p for _, _, m in new for p in m}
        found.update(p for m in whole.values() for p in m)
        self._fill(found.difference(pieces))
        get = pieces.__getitem__
        for known, w, m in new:
            known[w] = get(m[0]) if len(m) == 1 else b"".join(map(get, m))
        get_later = later.__getitem__
        return [
            b"".join(map(get, whole[k])) if k in whole else first[s[0]] + b"".join(map(get_later, s[1:])) for k, s in enumerate(split)
        ]

    def _apart(self, t: str) -> bool:
        """Whether every space stands alone between two other characters."""
        if "  " in t or t[:1] == " " or t[-1:] == " " or " \n" in t or "\n " in t:
            return False
        return not (self.odd(t) and self.loose(t))

    def decode(self, ids: np.ndarray) -> bytes:
        try:
            return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        except KeyError as e:
            raise ValueError(f"id {e} is not in the vocabulary") from None


def _codec(vocabulary: str | None, pattern: str | None) -> Codec:
    import public_tokenizers

    key = vocabulary or public_tokenizers.path(VOCABULARY), pattern or public_tokenizers.PATTERN
    return _CODECS.get(key) or _CODECS.setdefault(key, Codec(*key))


def _lists(blobs: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *[len(b) // 4 for b in blobs]])
    return pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(np.frombuffer(b"".join(blobs), "<i4"), pa.int32())).cast(
        pa.list_(pa.int32())
    )


def _parts(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about `BYTES` characters, whatever the lengths of the texts."""
    sizes = np.cumsum([n or 0 for n in pc.utf8_length(b.column(1)).to_pylist()])
    lo = 0
    while lo < b.num_rows:
        hi = int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + BYTES, "right"))
        hi = min(max(hi, lo + 1), lo + ROWS)
        yield b.slice(lo, hi - lo)
        lo = hi


def encode(docs: DataFrame, vocabulary: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id and ids (array of int) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary, pattern)
        for b in batches:
            for part in _parts(b):
                ids = _lists(codec.encode([t or "" for t in part.column(1).to_pylist()]))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], names=["doc_id", "ids"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """The rows of `tokens` (doc_id, ids) with `decoded`, the bytes of the ids."""
    src = tokens.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary, None)
        for b in batches:
            for k in range(0, b.num_rows, ROWS):
                part = b.slice(k, ROWS)
                out = [codec.decode(x.values.to_numpy(zero_copy_only=False)) if x.is_valid else b"" for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())], names=["doc_id", "ids", "decoded"])

    return src.mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def op12_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document encoded and decoded: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    both = decode(encode(documents(spark, sf_dir)))
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
