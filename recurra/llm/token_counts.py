"""Token counts by heap-and-linked-list byte-pair merging.

The vocabulary is a sentencepiece BPE model, of which only the pieces and
their scores are used. A text's symbols are its characters, each space as the
word mark, with one mark put in front. A heap holds adjacent pairs that form a
piece, best score first, then leftmost; each pop merges two symbols of a
linked list. The count is the initial symbols minus the merges, plus, for every
character that is no piece of its own, its further bytes (byte fallback). No
ids are made.

No piece has the mark after another character, and a character that is in no
longer piece never merges, so the text is cut before marks and around line
feeds and each cut-off piece is counted on its own; counts of short pieces are
remembered up to a bound.

Defined cases: null and empty texts have 0 tokens; repeated rows are counted
alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recurra.llm.common import documents

MARK = "▁"
LIMIT = 4096


_MERGERS: dict = {}  # one per worker and vocabulary


class PairMerger:
    """Counts by merging, for one vocabulary."""

    def __init__(self, path: str, most: int = 1_200_000):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        usable = [i for i in range(sp.vocab_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        order = sorted({sp.get_score(i) for i in usable}, reverse=True)
        place = {s: k for k, s in enumerate(order)}
        self.rank = {sp.id_to_piece(i): place[sp.get_score(i)] for i in usable}
        if any(MARK in p.lstrip(MARK) for p in self.rank):
            raise ValueError("a piece has the word mark inside; texts cannot be cut before it")
        self.line_alone = not any("\n" in p for p in self.rank)
        self.most = most
        self.later = _Remembered(self, MARK)  # a word after a space
        self.first = _Remembered(self, "")  # a word after a line feed

    def merged(self, s: str) -> int:
        """Tokens of a string whose spaces are marks already."""
        rank = self.rank
        sym: list = list(s)
        n = len(sym)
        count = n
        for c in sym:
            if c not in rank:
                count += len(c.encode("utf-8", "surrogatepass")) - 1
        get = rank.get
        heap = [(r, i, i + 1, 2) for i in range(n - 1) if (r := get(sym[i] + sym[i + 1])) is not None]
        if not heap:
            return count
        heapify(heap)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        size = [1] * n
        while heap:
            _, a, b, both = heappop(heap)
            if after[a] != b or size[a] + size[b] != both or not size[a]:
                continue  # one of the two has been merged meanwhile
            left = sym[a] = sym[a] + sym[b]
            size[a], size[b] = both, 0
            count -= 1
            nxt = after[a] = after[b]
            if nxt < n:
                before[nxt] = a
                if (r := get(left + sym[nxt])) is not None:
                    heappush(heap, (r, a, nxt, both + size[nxt]))
            prev = before[a]
            if prev >= 0 and (r := get(sym[prev] + left)) is not None:
                heappush(heap, (r, prev, a, size[prev] + both))
        return count

    def count(self, text: str) -> int:
        if not text:
            return 0
        if len(self.later) + len(self.first) > self.most:
            self.later.clear()
            self.first.clear()
        if MARK in text:
            text = text.replace(MARK, " ")
        if not self.line_alone or "  " in text or text[0] == " ":
            return sum(map(self.merged, re.findall(f"{MARK}+[^{MARK}]*", MARK + text.replace(" ", MARK))))
        later, first = self.later, self.first
        lines = text.split("\n")
        total = len(lines) - 1  # a line feed is one byte
        w = lines[0].split(" ")
        total += sum([later[x] for x in w])
        for line in lines[1:]:
            if line:
                w = line.split(" ")
                total += first[w[0]] + sum([later[x] for x in w[1:]])
        return total


class _Remembered(dict):
    def __init__(self, merger: PairMerger, lead: str):
        self.merger, self.lead = merger, lead

    def __missing__(self, word: str) -> int:
        n = self.merger.merged(self.lead + word)
        if len(word) <= 48:
            self[word] = n
        return n


def count_tokens(docs: DataFrame, vocabulary: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every document."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        path = vocabulary or public_tokenizers.path("piece_bpe_32k.model")
        merger = _MERGERS.get(path) or _MERGERS.setdefault(path, PairMerger(path))
        for b in batches:
            texts = b.column(1)
            counts = [merger.count(t.as_py() or "") for t in texts]
            sizes = texts.cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t.as_py() or b"") for t in sizes], pa.int64()), pa.array(counts, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    out = src.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole document: doc_id, n_bytes, n_tokens, over_limit."""
    return count_tokens(documents(spark, sf_dir))
