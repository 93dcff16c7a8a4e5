"""Two-pass external shuffle into shards.

Pass 1 scatters the records by a seeded hash into buckets of a bounded
expected size; pass 2 puts each bucket into canonical order, Fisher-Yates
shuffles it with a generator seeded by (seed, bucket) and writes it into its
shard's folder. A bucket is one task's group, sized by bytes, so memory does
not grow with the input; a rerun writes the same order. A shard has as
many buckets as its own bytes need, and the whole record decides the bucket, so
rows that share an id (or have none) are spread over their shard's buckets.
Rows equal in every column that would fill a bucket by themselves are counted,
and the copies, dealt out again by their number, are spread as well.

The law is `key`: a record's shard is the rendezvous winner of its `doc_id`
among the shard numbers, so the id and the shard count alone decide, and one
more shard takes rows only into itself.

Defined cases: a null text has 8 bytes and the checksum of no bytes; a null
`doc_id` hashes like any other value; repeated rows each get a slot of their
own; an empty table gives no rows; any further columns, of any name, travel
inside the record.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recurra.llm.common import documents, stage, stage_path, sums

BUCKET_BYTES = 24 << 20


def shard_of(doc_id, n_shards: int):
    """Rendezvous hashing: the shard number whose hash with the id wins."""
    scored = F.transform(F.sequence(F.lit(0), F.lit(n_shards - 1)), lambda s: F.struct(F.xxhash64(doc_id, s).alias("h"), s.alias("s")))
    return F.array_max(scored)["s"]


def without_maps(c: Column, kind: T.DataType) -> Column:
    """`c` with every map, at any depth, as its entries in order of their keys:
    what can be hashed, grouped and compared."""
    if not _holds_map(kind):
        return c
    if isinstance(kind, T.StructType):
        some = F.struct(*[without_maps(c[f.name], f.dataType).alias(f"c{k}") for k, f in enumerate(kind.fields)])
        return F.when(c.isNotNull(), some)
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: without_maps(x, kind.elementType))
    entry = lambda e: F.struct(without_maps(e["key"], kind.keyType).alias("k"), without_maps(e["value"], kind.valueType).alias("v"))
    return F.sort_array(F.transform(F.map_entries(c), entry))


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType) or (isinstance(kind, T.ArrayType) and _holds_map(kind.elementType))


def copies_spread(keyed: DataFrame, size, bucket_bytes: int) -> DataFrame:
    """`keyed` with `copy`: 0, and 0, 1, ... for equal rows of over
    `bucket_bytes` in all, whose records are counted and dealt out again."""
    many = keyed.groupBy("tie").agg(F.count("*").alias("n"), F.sum(size).alias("bytes"))
    many = stage(many.filter((F.col("n") > 1) & (F.col("bytes") > bucket_bytes)).select("tie"), "sharding-ties")  # fewer than buckets
    if many.isEmpty():
        return keyed.withColumn("copy", F.lit(0).cast("long"))
    equal = keyed.join(F.broadcast(many), "tie", "left_semi")
    content = without_maps(F.col("rec"), keyed.schema["rec"].dataType).alias("content")
    same = [c for c in keyed.columns if c != "rec"]
    equal = equal.groupBy(*same, content).agg(F.first("rec").alias("rec"), F.count("*").alias("n")).select(*keyed.columns, "n")
    piece = F.greatest(F.lit(1), F.floor(F.lit(bucket_bytes // 8) / size)).cast("long")  # copies dealt out in one go
    equal = stage(equal.select("*", piece.alias("piece")), "sharding-equal")
    pieces = sums(equal, n=F.sum(F.ceil(F.col("n") / F.col("piece"))))["n"]
    spread = (
        equal.withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.col("piece"))))
        .repartition(max(1, min(pieces, 2000)), "tie", "from")
        .withColumn("copy", F.explode(F.sequence("from", F.least(F.col("from") + F.col("piece"), F.col("n")) - 1)))
    )
    rest = keyed.join(F.broadcast(many), "tie", "left_anti").withColumn("copy", F.lit(0).cast("long"))
    return rest.select(*keyed.columns, "copy").unionByName(spread.select(*keyed.columns, "copy"))


def bucketed(docs: DataFrame, n_shards: int, seed: int, bucket_bytes: int) -> DataFrame:
    """`rec`, `shard`, `grown_shard`, `tie` and `bucket` of every row."""
    size = (F.octet_length(F.coalesce(F.col("rec.text"), F.lit(""))) + F.lit(8)).cast("long")
    recs = docs.select(F.struct("*").alias("rec"))
    keyed = recs.select(
        "rec",
        shard_of(F.col("rec.doc_id"), n_shards).alias("shard"),
        shard_of(F.col("rec.doc_id"), n_shards + 1).alias("grown_shard"),
        F.xxhash64(without_maps(F.col("rec"), recs.schema["rec"].dataType)).alias("tie"),
    )
    held = dict(keyed.groupBy("shard").agg(F.sum(size)).collect())  # a row a shard
    buckets = [max(1, -(-held.get(s, 0) // bucket_bytes)) for s in range(n_shards)]
    nth = lambda values: F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), F.col("shard") + 1)
    starts = [sum(buckets[:s]) for s in range(n_shards)]
    hashed = F.when(F.col("copy") == 0, F.xxhash64("tie", F.lit(seed))).otherwise(F.xxhash64("tie", F.lit(seed), "copy"))
    return copies_spread(keyed, size, bucket_bytes).withColumn("bucket", nth(starts) + F.pmod(hashed, nth(buckets))).drop("copy")


def shuffle_to_shards(
    docs: DataFrame, out: str, n_shards: int = 24, seed: int = 7, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """Write `docs` shuffled into folders `out/shard=N` and return the written
    table: `rec` (the whole record), `shard`, `slot` (gapless from 0 in each
    shard) and `grown_shard` (with one more shard)."""
    spark = docs.sparkSession
    keyed = bucketed(docs, n_shards, seed, bucket_bytes)

    # where each bucket begins in its shard: counted without moving the records
    first = (
        keyed.groupBy("shard", "bucket")
        .agg(F.count("*").alias("n"))
        .select(F.col("bucket").alias("bucket"), (F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")).alias("before"))
    )

    def fisher_yates(key: tuple[pa.Scalar, ...], table: pa.Table, before: pa.Table) -> pa.Table:
        order = pc.sort_indices(
            pa.table({"id": pc.struct_field(table["rec"], "doc_id"), "tie": table["tie"]}),
            sort_keys=[("id", "ascending"), ("tie", "ascending")],
        ).to_numpy()
        order = order.copy()
        np.random.default_rng([seed, key[0].as_py()]).shuffle(order)  # Fisher-Yates, in place
        slot = before["before"][0].as_py() + np.arange(len(order))
        return table.select(["rec", "shard", "grown_shard"]).take(pa.array(order)).append_column("slot", pa.array(slot, pa.int64()))

    schema = keyed.select("rec", "shard", "grown_shard").withColumn("slot", F.lit(0).cast("long")).schema
    written = keyed.groupBy("bucket").cogroup(first.groupBy("bucket")).applyInArrow(fisher_yates, schema)
    written.write.option("compression", "zstd").partitionBy("shard").parquet(out)
    return spark.read.schema(schema).parquet(out)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    out = shuffle_to_shards(documents(spark, sf_dir), stage_path(spark, "shards"))
    text = F.coalesce(F.col("rec.text"), F.lit("")).cast("binary")
    return out.select(
        F.col("rec.doc_id").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.col("grown_shard").cast("int").alias("grown_shard"),
    )
