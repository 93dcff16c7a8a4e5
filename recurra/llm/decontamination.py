"""Benchmark decontamination by size-partitioned MinHash containment search.

An item is contained in a document when at least 75 % of the item's distinct
5-word shingles (words lower-cased, A-Z) occur in it. Banded MinHash misses
short items in long documents, whose Jaccard similarity is near zero; here the
sketch of an item of q shingles is its q - need + 1 smallest hashes, where
`need` is the fewest shingles that make it contained: a document that contains
the item holds at least one of them. Documents are partitioned by size in
powers of two; a partition asks only for items that can fit it, and keeps only
shingle hashes up to the largest sketch hash of those. Candidates are verified
by exact containment of shingles, so nothing is missed and nothing is guessed.

The benchmark is broadcast in blocks of about ITEM_BYTES at most (text and a
fixed share for each row), or of one longer item; a larger benchmark takes more
passes over the documents, never a larger block. Rows equal in item_id and text
are broadcast once with their number, and rows without text not at all.

Defined cases: an item of fewer than five words is one shingle, its whole word
sequence; null or empty items are contained nowhere and null or empty
documents contain nothing; repeated rows are matched each on their own; empty
tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recurra.llm.common import Block, Words, documents, filter_documents, id_and_text, ngram_hashes, small_blocks, sums, table

SHINGLE = 5
PERCENT = 75
ITEM_BYTES = 16 << 20
ROW_BYTES = 64  # of an item besides its text
OUT_ROWS = 10_000  # found rows sent at a time
SCHEMA = "doc_id long, item_id long, n_shared long, n_item long"


class ItemIndex:
    """Sketches and shingles of a block of items."""

    def __init__(self, ids: list, texts: list):
        b = Block.of(ids, [None if t is None else t.encode() for t in texts])
        w = Words(b, lower=True)
        self.ids = ids
        self.shingles: list[np.ndarray] = []
        self.width: list[int] = []
        keys, owners, self.need = [], [], []
        for k in range(len(ids)):
            h = w.hash[w.first[k] : w.first[k + 1]]
            n = min(SHINGLE, len(h))
            s = np.unique(ngram_hashes(h, n)) if n else np.empty(0, np.uint64)
            need = -(-PERCENT * len(s) // 100)
            self.shingles.append(s)
            self.width.append(n)
            self.need.append(need)
            sketch = s[: len(s) - need + 1] if len(s) else s
            keys.append(sketch)
            owners.append(np.full(len(sketch), k))
        self.widths = sorted({n for n in self.width if n})
        key = np.concatenate([np.empty(0, np.uint64), *keys])
        owner = np.concatenate([np.empty(0, np.int64), *owners])
        order = np.argsort(key, kind="stable")
        self.key, self.owner = key[order], owner[order]
        need = np.array(self.need)
        # the largest sketch hash asked for by items that fit documents of under 2^c shingles
        self.ceiling = np.zeros(64, np.uint64)
        for c in range(64):
            fits = need[self.owner] < 2**c if len(self.key) else np.empty(0, bool)
            self.ceiling[c] = self.key[fits].max() if fits.any() else 0

    def search(self, b: Block) -> Iterator[tuple[int, int, int]]:
        """(document, item, shared shingles) in a block of documents."""
        w = Words(b, lower=True)
        for n in self.widths:
            h = ngram_hashes(w.hash, n)
            doc = w.doc[: len(h)]
            inside = np.arange(len(h)) + n <= w.first[doc + 1]
            size = np.maximum(w.count - n + 1, 0)
            top = self.ceiling[np.ceil(np.log2(size + 1)).astype(int)]
            at = np.flatnonzero(inside & (h <= top[doc]))
            lo = np.searchsorted(self.key, h[at], "left")
            hi = np.searchsorted(self.key, h[at], "right")
            hit = np.flatnonzero(hi > lo)
            pairs = {(int(doc[at[i]]), int(self.owner[j])) for i in hit for j in range(lo[i], hi[i])}
            for d, k in sorted(pairs):
                if self.width[k] != n:
                    continue
                own = h[w.first[d] : max(w.first[d], w.first[d + 1] - n + 1)]
                shared = int(np.isin(self.shingles[k], own).sum())
                if shared >= self.need[k]:
                    yield d, k, shared


def item_blocks(items: DataFrame, item_bytes: int = ITEM_BYTES) -> Iterator:
    """The benchmark's distinct items with text as broadcast (ids, texts, how
    many rows each has), at most about `item_bytes` each."""
    spark = items.sparkSession
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.filter(F.octet_length("text") > 0).groupBy("item_id", "text").agg(F.count("*").alias("n"))
    size = sums(items, b=F.sum(F.octet_length("text").cast("long") + ROW_BYTES))["b"]
    n_blocks = max(1, -(-2 * size // item_bytes))  # a hash fills no block to twice its share
    for k in range(n_blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == k).collect()
        yield spark.sparkContext.broadcast(([r["item_id"] for r in rows], [r["text"] for r in rows], [r["n"] for r in rows]))


def drop_contaminated(docs: DataFrame, items: DataFrame, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """The rows of `docs`, all columns, that contain no item."""
    for index in item_blocks(items, item_bytes):

        def make(index=index):
            found = ItemIndex(*index.value[:2])

            def keep(b: Block) -> np.ndarray:
                clean = np.ones(len(b), bool)
                clean[[d for d, _, _ in found.search(b)]] = False
                return clean

            return keep

        docs = filter_documents(docs, make)
    return docs


def contained_items(docs: DataFrame, items: DataFrame, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """doc_id, item_id, n_shared, n_item for each item contained in a document."""
    src = id_and_text(docs)
    out = None
    for index in item_blocks(items, item_bytes):

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            found = ItemIndex(*index.value[:2])
            times = np.array(index.value[2], np.int64)
            for b in small_blocks(batches):
                got = list(found.search(b))
                end = np.cumsum(times[[i for _, i, _ in got]]) if got else np.empty(0, np.int64)
                # a row for every row of the item, some at a time
                for lo in range(0, int(end[-1]) if got else 0, OUT_ROWS):
                    rows = [got[k] for k in np.searchsorted(end, np.arange(lo, min(lo + OUT_ROWS, int(end[-1]))), "right")]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": b.doc_ids().take(pa.array([d for d, _, _ in rows], pa.int64())),
                            "item_id": pa.array([found.ids[i] for _, i, _ in rows], pa.int64()),
                            "n_shared": pa.array([s for _, _, s in rows], pa.int64()),
                            "n_item": pa.array([len(found.shingles[i]) for _, i, _ in rows], pa.int64()),
                        }
                    )

        part = src.mapInArrow(run, SCHEMA)
        out = part if out is None else out.unionByName(part)
    return out


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in documents: doc_id, item_id, n_shared, n_item, containment."""
    found = contained_items(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.withColumn("containment", F.col("n_shared") / F.col("n_item"))


WORDS = "regexp_extract_all(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')"


def shingle_sql(table: str, key: str, width: str) -> str:
    """DuckDB: distinct (key, shingle) of every row of `table`; `width` is a
    column of `table` or a number."""
    return f"""
  SELECT DISTINCT {key}, width, array_to_string(w[i : i + width - 1], ' ') AS shingle FROM (
    SELECT {key}, width, w, unnest(range(1, len(w) - width + 2)) AS i FROM (
      SELECT {key}, {width} AS width, {WORDS.format(t="coalesce(text, '')")} AS w FROM {table}
    ) WHERE width > 0 AND len(w) >= width
  )"""


OP8_SQL = f"""
WITH b AS (
  SELECT item_id, text, least(5, len({WORDS.format(t="coalesce(text, '')")})) AS w_n FROM benchmark
), item AS ({shingle_sql("b", "item_id", "w_n")}
), widths AS (SELECT DISTINCT w_n FROM b
), d AS (SELECT doc_id, text, w_n FROM documents, widths
), doc AS ({shingle_sql("d", "doc_id", "w_n")}
), size AS (SELECT item_id, count(*) AS n_item FROM item GROUP BY item_id
), shared AS (
  SELECT doc_id, item_id, count(*) AS n_shared FROM item JOIN doc USING (width, shingle) GROUP BY ALL
)
SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment
FROM shared JOIN size USING (item_id) WHERE 100 * n_shared >= 75 * n_item
"""
