"""Spark session settings and lineage cuts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    # arrays of a customer's months are gathered by hashing, not by another sort
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "16384",
    # plans name the whole folder of a scan
    "spark.sql.maxMetadataStringLength": "500",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    app: str = "recurra",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session for tests and benchmarks (a cluster supplies its own)."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master.startswith("local"):
        # Local mode runs everything in the driver JVM.
        conf["spark.driver.memory"] = "16g"
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder that stage tables go to: the session's
    `spark.checkpoint.dir`, else (tests, a laptop) its warehouse folder. Both
    are settings of the session; nothing here chooses a machine-local one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return folder.rstrip("/")


def delete_folder(spark: SparkSession, path: str) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(conf).delete(target, True)


def materialize(df: DataFrame, name: str = "stage", written: list[str] | None = None) -> DataFrame:
    """Cut lineage: write `df` as a Parquet table under the shared
    checkpoint folder and read it back.

    Unlike `Dataset.checkpoint()` (which recomputes an unpersisted plan to
    save it, and stores serialized rows) this computes the plan once, and
    later readers get column pruning and filter pushdown. The files live in
    the cluster's shared folder, so the loss of an executor never loses a
    finished stage. The path is added to `written`, whose owner deletes it
    (`Pipeline.drop_stages`).
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/recurra-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", STAGE_CODEC).parquet(path)
    if written is not None:
        written.append(path)
    return spark.read.schema(df.schema).parquet(path)


#: Stage tables are read once or twice by the cluster that wrote them.
STAGE_CODEC = "zstd"
#: Orders of a bucket, as stored: a bucket's customer-months (some sixteen
#: times as many rows, not compressed) are sorted by one task in memory.
BUCKET_BYTES = 4 << 20
MOST_BUCKETS = 20_000


def folder_bytes(spark: SparkSession, path: str) -> int:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(conf).getContentSummary(target).getLength()


def bucket_count(spark: SparkSession, size: int) -> int:
    """Buckets for about `size` bytes: one a slot at least."""
    slots = spark.sparkContext.defaultParallelism
    return max(1, min(MOST_BUCKETS, max(slots, -(-size // BUCKET_BYTES))))


def materialize_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int, written: list[str] | None = None) -> DataFrame:
    """As `materialize`, in `buckets` by `keys`: a join or aggregate on `keys`
    reads the rows as they lie. `df` comes partitioned so (else each task
    writes to many buckets). Buckets are known to a table only, so this is one
    of the session's catalog, its files under the shared folder; `written`
    gets both."""
    spark = df.sparkSession
    ident = f"recurra_{name}_{uuid.uuid4().hex}".replace("-", "_")
    path = f"{ensure_checkpoint_dir(spark)}/{ident}"
    writer = df.write.format("parquet").option("compression", STAGE_CODEC).bucketBy(buckets, *keys)
    writer.option("path", path).saveAsTable(ident)
    if written is not None:
        written += [path, TABLE_MARK + ident]
    return spark.table(ident)


#: Before the name of a table among the stages written.
TABLE_MARK = "table:"


def drop_stage(spark: SparkSession, stage: str) -> None:
    if stage.startswith(TABLE_MARK):
        spark.sql(f"DROP TABLE IF EXISTS {stage.removeprefix(TABLE_MARK)}")
    else:
        delete_folder(spark, stage)
