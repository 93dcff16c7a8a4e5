"""Hierarchical multi-length packing of tokenized documents.

Each document becomes its token ids and an end id. Whole windows of the
longest length are cut off first; the rest of a document is routed to the
shortest tier (a power of two) that holds it. Tiers are packed from the
longest down: what a window lacks is filled from shorter tiers, whole rests
first (largest that fits), then by cutting one. What remains at the end of a
group of documents is cut into powers of two, which need no padding. The
sequences of a group are dealt to step groups of nearly equal token counts.

Packing is a narrow pass: each task packs the documents it reads, a bounded
group of tokens at a time, so nothing is shuffled and memory does not grow.

Tokens are those of the `tokenizers` file. The text is split where that
tokenizer always splits (before a space or around a line feed between two
words), and the ids of each such piece are remembered, up to a bound, so that
a repeated word is merged once per worker; new pieces are merged by `tiktoken`
with the vocabulary read from the same file, which is a few times faster and
gives the same ids (tested). Texts with any other white space, and those that
hold the string of an added token (which the library's default makes that
token), go to `tokenizers` whole.

Defined cases: a null or empty text is its end id alone; repeated rows are
packed like any others; a null `doc_id` stays null; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import os
import re
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recurra.llm.common import documents

TIERS = (2048, 1024, 512, 256)
GROUP_TOKENS = 2 << 20
STEP_TOKENS = 1 << 16
END_ID = 1
SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, "
    "sequence_id long, offset long, tier int, step_group long"
)

#: White space (or near it) other than spaces and line feeds.
_ODD = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]")


def _plain(t: str) -> bool:
    """Only single spaces and line feeds, each between two words."""
    inside = not ("  " in t or " \n" in t or "\n " in t or "\n\n" in t or _ODD.search(t))
    return inside and not (t[:1] in (" ", "\n") or t[-1:] in (" ", "\n")) if t else True


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the
    others, in order, as the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


_CACHES: dict = {}  # one per worker and vocabulary


class IdCache:
    """Token ids of texts as little-endian uint32 bytes."""

    def __init__(self, path: str, most: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        special = {t.content for t in self.tok.get_added_tokens_decoder().values()}
        #: A text that holds the string of an added token goes to the library whole.
        self.added = re.compile("|".join(map(re.escape, sorted(special)))).search if special else lambda t: None
        as_byte = _byte_letters()
        ranks = {bytes(as_byte[c] for c in t): i for t, i in self.tok.get_vocab().items() if t not in special}
        self.pieces = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.most = most
        self.known: dict[str, bytes] = {}  # a word after one space, or a line feed and the word after it
        self.first: dict[str, bytes] = {}  # a word at the start of a text
        self.line = self._ids(["\n"])[0]

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _fill(self, cache: dict[str, bytes], new: list[str], lead: str, before: bytes = b"") -> None:
        """Remember the ids of new words, `before` in front of them. They are
        encoded as the lines of one text, since a line feed between words is
        always a token of its own."""
        line = int(np.frombuffer(self.line, "<u4")[0])
        for k in range(0, len(new), 2000):
            some = new[k : k + 2000]
            words = [w[len(before) // 4 :] for w in some]  # `before` is one token, and one character of the key
            ids = np.array(self.pieces.encode_ordinary("\n".join([lead + w for w in words])), "<u4")
            raw, cut = ids.tobytes(), 4 * np.flatnonzero(ids == line)
            if len(cut) != len(some) - 1:
                raise ValueError("the tokenizer does not keep line feeds apart")
            ends = [*cut.tolist(), len(raw)]
            cache.update(zip(some, (before + raw[i:j] for i, j in zip([0, *(4 + cut).tolist()], ends))))

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.first) + len(self.known) > self.most:
            self.first.clear()
            self.known.clear()
        split: list = []
        first: set[str] = set()
        new: set[str] = set()
        known = self.known
        get = known.get
        for t in texts:
            if not _plain(t) or self.added(t):
                split.append(None)
                continue
            head, *rest = t.replace("\n", " \n").split(" ")
            ids = list(map(get, rest))
            missing = [k for k, x in enumerate(ids) if x is None]
            words = [rest[k] for k in missing]
            split.append((head, ids, missing, words))
            first.add(head)
            new.update(words)
        self._fill(self.first, [w for w in first if w not in self.first], "")
        self._fill(known, [w for w in new if w[:1] != "\n"], " ")
        self._fill(known, [w for w in new if w[:1] == "\n"], "", self.line)
        whole = iter(self._ids([t for t, s in zip(texts, split) if s is None]))
        out: list[bytes] = []
        for s in split:
            if s is None:
                out.append(next(whole))
                continue
            head, ids, missing, words = s
            for k, w in zip(missing, words):
                ids[k] = known[w]
            out.append(self.first[head] + b"".join(ids))
        return out


def pack_lengths(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Sequences as (tier, [(document, start, length), ...]) that hold every
    token of documents of these lengths exactly once."""
    top = tiers[0]
    out: list = []
    pool: dict[int, list] = {t: [] for t in tiers}
    for d, n in enumerate(lengths):
        whole = n - n % top
        out += [(top, [(d, s, top)]) for s in range(0, whole, top)]
        if n > whole:
            tier = min(t for t in tiers if t >= n - whole)
            pool[tier].append((n - whole, d, whole))
    rest: list = sorted(x for t in tiers[1:] for x in pool[t])  # all that is shorter than the tier at hand
    tail: list = []
    for k, tier in enumerate(tiers):
        mine = sorted(pool[tier]) if k == 0 else [x for x in rest if x[0] > (tiers[k + 1] if k + 1 < len(tiers) else 0)]
        if k:
            rest = rest[: len(rest) - len(mine)]
        while mine:
            size, d, s = mine.pop()
            seq, gap = [(d, s, size)], tier - size
            while gap:
                if j := bisect_right(rest, (gap, float("inf"))):
                    n, d, s = rest.pop(j - 1)
                    seq.append((d, s, n))
                    gap -= n
                elif rest or mine:
                    n, d, s = rest.pop() if rest else mine.pop(0)
                    if n <= gap:
                        seq.append((d, s, n))
                        gap -= n
                        continue
                    seq.append((d, s, gap))
                    left = (n - gap, d, s + gap)
                    low = tiers[k + 1] if k + 1 < len(tiers) else 0
                    insort(rest if left[0] <= low else mine, left)
                    gap = 0
                else:
                    break
            if gap:
                tail += seq
            else:
                out.append((tier, seq))
    total = sum(n for _, _, n in tail)
    while tail:
        size = 1 << (total.bit_length() - 1)
        size = min(size, top)
        total -= size
        seq, gap = [], size
        while gap:
            d, s, n = tail.pop()
            use = min(n, gap)
            seq.append((d, s, use))
            gap -= use
            if n > use:
                tail.append((d, s + use, n - use))
        out.append((size, seq))
    return out


def step_groups(sizes: list[int], step_tokens: int = STEP_TOKENS) -> list[int]:
    """A group for each sequence: longest first, dealt back and forth."""
    n = max(1, -(-sum(sizes) // step_tokens))
    group = [0] * len(sizes)
    for i, k in enumerate(sorted(range(len(sizes)), key=lambda k: -sizes[k])):
        lap, at = divmod(i, n)
        group[k] = at if lap % 2 == 0 else n - 1 - at
    return group


def pack(docs: DataFrame, vocabulary: str | None = None, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """One row per piece: its document, place and ids, and its sequence."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        path = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
        cache = _CACHES.get(path) or _CACHES.setdefault(path, IdCache(path))
        base = TaskContext.get().partitionId() << 40
        end = np.array([END_ID], "<u4").tobytes()
        n_seq = n_step = 0
        held: list = []
        tokens = 0

        def flush():
            nonlocal n_seq, n_step, held, tokens
            seqs = pack_lengths([len(x) // 4 for _, x in held])
            group = step_groups([t for t, _ in seqs])
            cols: list[list] = [[] for _ in range(9)]
            for (tier, seq), g in zip(seqs, group):
                at = 0
                for d, s, n in seq:
                    i, x = held[d]
                    row = (i, s, n, x[4 * s : 4 * (s + n)], len(x) // 4, base + n_seq, at, tier, base + n_step + g)
                    for c, v in zip(cols, row):
                        c.append(v)
                    at += n
                n_seq += 1
            n_step += max(group, default=-1) + 1
            held, tokens = [], 0
            kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3 + [pa.int32(), pa.int64()]
            names = [x.split()[0] for x in SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                texts = [t or "" for t in part.column(1).to_pylist()]
                for i, x in zip(part.column(0).to_pylist(), cache.encode(texts)):
                    held.append((i, x + end))
                    tokens += len(x) // 4 + 1
                if tokens >= group_tokens:
                    yield flush()
        if held:
            yield flush()

    return src.mapInArrow(run, SCHEMA)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step_group."""
    return pack(documents(spark, sf_dir)).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "tier", "step_group"
    )
