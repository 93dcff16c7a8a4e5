"""Shared helpers: stage tables, corpus blocks, word and n-gram hashing.

A *corpus block* is one row that holds a few megabytes of documents
(compressed), so that Spark moves and joins few large rows and numpy works on
whole blocks. The block table is written once under the shared checkpoint
folder; a document is known by (block, index in the block), so null or
repeated `doc_id`s need no special care.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
BLOCK_BYTES = 2 << 20


# --- stage tables ------------------------------------------------------------


def stage_root(spark: SparkSession) -> str:
    """`spark.checkpoint.dir` of the session; where it is unset (tests, a
    laptop), the session's warehouse folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return root.rstrip("/")


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{stage_root(spark)}/recurra-llm-{name}-{uuid.uuid4().hex}"


_stages: list[str] = []  # tables written and not yet dropped


def stage(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write `df` once under the shared folder and read it back: cuts the
    lineage, and no lost executor takes it along."""
    path = stage_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    _stages.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stages(spark: SparkSession, but: int = 0) -> int:
    """Delete the stage tables written so far except the first `but`, once
    nothing reads them any more; returns how many are left."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while len(_stages) > but:
        path = jvm.org.apache.hadoop.fs.Path(_stages.pop())
        path.getFileSystem(conf).delete(path, True)
    return len(_stages)


def stages_written() -> int:
    return len(_stages)


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that they
    need no copy of it on their own path."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="recurra-code-")) / "recurra_code.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    sc.addPyFile(str(target))
    _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def sums(df: DataFrame, **cols) -> dict[str, int]:
    """A few whole-table aggregates as one row."""
    row = df.agg(*[c.alias(k) for k, c in cols.items()]).first()
    return {k: int(row[k] or 0) for k in cols}


# --- corpus blocks -----------------------------------------------------------

BLOCK_SCHEMA = "block long, n int, n_bytes long, n_words long, ids binary, id_null binary, lens binary, body binary, rest binary"


class Block:
    """Decoded block: `ids` int64, `id_null` bool, `lens` int64 (-1: null
    text), `buf` uint8 with one separator byte after every document, and
    `starts`, where each document begins in `buf`."""

    def __init__(self, row: dict):
        self.block = row["block"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.id_null = np.frombuffer(row["id_null"], np.bool_)
        self.raw_lens = np.frombuffer(row["lens"], np.int64)
        self.lens = np.maximum(self.raw_lens, 0)
        body = zstandard.ZstdDecompressor().decompress(row["body"], max_output_size=max(1, row["n_bytes"] + row["n"]))
        self.buf = np.frombuffer(body, np.uint8)
        self.starts = np.concatenate([[0], np.cumsum(self.lens + 1)])[:-1].astype(np.int64)
        self.ends = self.starts + self.lens

    @classmethod
    def of(cls, ids: list, texts: list) -> "Block":
        """A block of these ids and UTF-8 texts (or None)."""
        b = cls.__new__(cls)
        b.block = 0
        b.ids = np.array([i or 0 for i in ids], np.int64)
        b.id_null = np.array([i is None for i in ids], np.bool_)
        b.raw_lens = np.array([-1 if t is None else len(t) for t in texts], np.int64)
        b.lens = np.maximum(b.raw_lens, 0)
        b.buf = np.frombuffer(b"".join([(t or b"") + b"\n" for t in texts]), np.uint8)
        b.starts = np.concatenate([[0], np.cumsum(b.lens + 1)])[:-1].astype(np.int64)
        b.ends = b.starts + b.lens
        return b

    def doc_ids(self) -> pa.Array:
        return pa.array(self.ids, pa.int64(), mask=self.id_null)

    def __len__(self) -> int:
        return len(self.ids)

    def text(self, i: int) -> bytes:
        return self.buf[self.starts[i] : self.ends[i]].tobytes()


def _count_words(buf: np.ndarray) -> int:
    blank = is_blank(buf)
    return int(np.count_nonzero(blank[1:] & ~blank[:-1])) if len(buf) else 0


def corpus_blocks(docs: DataFrame, name: str, block_bytes: int = BLOCK_BYTES, carry: bool = False) -> DataFrame:
    """`documents` packed into blocks of about `block_bytes` (a longer single
    text is a block of its own) and written as a stage table; with `carry`, the
    blocks also hold the other columns, for `block_rows`."""
    other = [c for c in docs.columns if c not in ("doc_id", "text")] if carry else []
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *other)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, serial = TaskContext.get().partitionId(), 0
        zip_ = zstandard.ZstdCompressor(level=3)
        ids: list = []
        texts: list = []
        rest: list = []
        size = 0

        def flush():
            nonlocal ids, texts, rest, size, serial
            raw = b"".join(t + b"\n" if t is not None else b"\n" for t in texts)
            sink = pa.BufferOutputStream()
            if rest:
                with pa.ipc.new_stream(sink, rest[0].schema) as out:
                    for r in rest:
                        out.write_batch(r)
            row = {
                "block": [(part << 32) | serial],
                "n": [len(ids)],
                "n_bytes": [len(raw) - len(ids)],
                "n_words": [_count_words(np.frombuffer(raw, np.uint8))],
                "ids": [np.array([i or 0 for i in ids], np.int64).tobytes()],
                "id_null": [np.array([i is None for i in ids], np.bool_).tobytes()],
                "lens": [np.array([-1 if t is None else len(t) for t in texts], np.int64).tobytes()],
                "body": [zip_.compress(raw)],
                "rest": [zip_.compress(sink.getvalue().to_pybytes())],
            }
            serial += 1
            ids, texts, rest, size = [], [], [], 0
            return pa.RecordBatch.from_pydict(
                {k: pa.array(v, pa.binary() if isinstance(v[0], bytes) else pa.int32() if k == "n" else pa.int64()) for k, v in row.items()}
            )

        for b in batches:
            doc_ids = b.column(0).to_pylist()
            more = pa.RecordBatch.from_arrays(b.columns[2:], names=b.schema.names[2:]) if other else None
            lo = 0
            for k, (i, t) in enumerate(zip(doc_ids, b.column(1).cast(pa.binary()).to_pylist())):
                ids.append(i)
                texts.append(t)
                size += len(t or b"")
                if size >= block_bytes:
                    if other:
                        rest.append(more.slice(lo, k + 1 - lo))
                    lo = k + 1
                    yield flush()
            if other and lo < b.num_rows:
                rest.append(more.slice(lo))
        if ids:
            yield flush()

    return stage(src.mapInArrow(pack, BLOCK_SCHEMA), name, "uncompressed")


def block_rows(row: dict, block: Block, keep: np.ndarray, columns: list[str], new: dict[str, pa.Array]) -> pa.RecordBatch:
    """The kept documents of a block with all `columns`; `new` replaces some,
    and those of `doc_id` and `text` come from the block itself."""
    cols = dict(new)
    cols.setdefault("doc_id", block.doc_ids())
    if "text" not in cols:
        cols["text"] = pa.array([None if n < 0 else block.text(i) for i, n in enumerate(block.raw_lens.tolist())], pa.binary()).cast(pa.string())
    raw = zstandard.ZstdDecompressor().decompressobj().decompress(row["rest"])
    if raw:
        held = pa.ipc.open_stream(raw).read_all().combine_chunks()
        for c in held.column_names:
            cols.setdefault(c, held[c].combine_chunks() if len(held) else held[c])
    flat = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (cols[c] for c in columns)]
    return pa.RecordBatch.from_arrays(flat, names=columns).filter(pa.array(keep))


def filter_documents(docs: DataFrame, make: Callable[[], Callable[[Block], np.ndarray]]) -> DataFrame:
    """The rows of `docs` that `make()(block)` keeps, in one narrow pass."""
    at_id, at_text = docs.columns.index("doc_id"), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = make()
        for b in batches:
            pair = pa.RecordBatch.from_arrays([b.column(at_id).cast(pa.int64()), b.column(at_text).cast(pa.string())], names=["doc_id", "text"])
            masks = [keep(x) for x in small_blocks([pair])]
            if masks:
                yield b.filter(pa.array(np.concatenate(masks).astype(bool)))

    return docs.mapInArrow(run, docs.schema)


def id_and_text(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def small_blocks(batches: Iterator[pa.RecordBatch], block_bytes: int = 1 << 20) -> Iterator[Block]:
    """Blocks of about `block_bytes` from batches of (doc_id, text): what a
    narrow pass works on at a time."""
    for b in batches:
        ids = b.column(0)
        texts = b.column(1).cast(pa.binary())
        size = np.cumsum([0 if n is None else n for n in pc.binary_length(texts).to_pylist()]) if b.num_rows else []
        lo = 0
        while lo < b.num_rows:
            hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + block_bytes, "right")))
            yield Block.of(ids.slice(lo, hi - lo).to_pylist(), texts.slice(lo, hi - lo).to_pylist())
            lo = hi


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Row dicts of Arrow batches, one at a time."""
    for b in batches:
        names = b.schema.names
        for i in range(b.num_rows):
            yield {k: b.column(j)[i].as_py() for j, k in enumerate(names)}


# --- bytes to words ----------------------------------------------------------


def is_blank(buf: np.ndarray) -> np.ndarray:
    """The word separators: space and 0x09-0x0D."""
    return (buf == 32) | ((buf - np.uint8(9)) < 5)


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    return np.where((buf - np.uint8(65)) < 26, buf + np.uint8(32), buf)


def words(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in `buf`."""
    edge = np.diff(np.concatenate([[False], ~is_blank(buf), [False]]).view(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (bijective), in place."""
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_R = 0x9E3779B97F4A7C15
_R_INV = pow(_R, -1, 1 << 64)
_pow: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    got = _pow.get(base)
    if got is None or len(got) < n:
        size = 1 << max(16, (n - 1).bit_length())
        got = np.full(size, base, U64)
        got[0] = 1
        _pow[base] = got = np.multiply.accumulate(got)
    return got[:n]


def word_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, span: int = 1 << 20) -> np.ndarray:
    """A 64-bit hash of every word, from prefix sums over pieces of `buf` of
    about `span` bytes, cut between words."""
    out = np.empty(len(start), U64)
    lo = 0
    while lo < len(start):
        hi = max(lo + 1, int(np.searchsorted(end, start[lo] + span, "right")))
        a, b = int(start[lo]), int(end[hi - 1])
        seg = buf[a:b].astype(U64)
        seg += U64(1)
        seg *= _powers(_R, b - a)
        acc = np.concatenate([np.zeros(1, U64), np.cumsum(seg, dtype=U64)])
        s, e = start[lo:hi] - a, end[lo:hi] - a
        out[lo:hi] = (acc[e] - acc[s]) * _powers(_R_INV, b - a)[s] + (e - s).astype(U64) * U64(0xD6E8FEB86659FD93)
        lo = hi
    return mix(out)


def ngram_hashes(wh: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of `n` consecutive entries of `wh`."""
    m = len(wh) - n + 1
    if m <= 0:
        return np.empty(0, U64)
    out = np.full(m, n, U64)
    for j in range(n):
        out *= U64(0xA0761D6478BD642F)
        out += wh[j : j + m]
        out ^= out >> U64(29)
    return mix(out)


class Words:
    """The words of a block: `start`/`end` in the buffer, `doc` of each, the
    hash of each, and `first`, the first word of each document (one more entry
    closes the last)."""

    def __init__(self, block: Block, lower: bool = False):
        buf = lower_ascii(block.buf) if lower else block.buf
        self.start, self.end = words(buf)
        self.hash = word_hashes(buf, self.start, self.end)
        self.first = np.searchsorted(self.start, np.concatenate([block.starts, [len(block.buf)]]))
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(block)), self.count)


# --- compact exchange of hashes ----------------------------------------------


def pack_arrays(*arrays: np.ndarray) -> bytes:
    """Several numpy arrays as one compressed blob."""
    head = np.array([len(arrays)] + [x for a in arrays for x in (a.dtype.num, len(a))], np.int64)
    return zstandard.ZstdCompressor(level=1).compress(b"".join([head.tobytes(), *[a.tobytes() for a in arrays]]))


_BY_NUM = {np.dtype(t).num: np.dtype(t) for t in ("b", "B", "h", "H", "i", "I", "l", "L", "f", "d", "?")}


def unpack_arrays(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    head = np.frombuffer(raw, np.int64, 2 * n, 8)
    out, at = [], 8 + 16 * n
    for num, size in head.reshape(n, 2):
        t = _BY_NUM[int(num)]
        out.append(np.frombuffer(raw, t, int(size), at))
        at += t.itemsize * int(size)
    return out


def delta(sorted_u64: np.ndarray) -> np.ndarray:
    return np.diff(sorted_u64, prepend=U64(0)).astype(U64)


def undelta(d: np.ndarray) -> np.ndarray:
    return np.cumsum(d, dtype=U64)
