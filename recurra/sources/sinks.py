"""Output writers. Every run is a full rebuild (overwrite)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

RUN_PREFIX = "run-"
_POINTER = "current"
_ASIDE = ".current-"


def write_table(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    fmt: str = "parquet",
) -> None:
    """Overwrite `path`, optionally partitioned (e.g. by `for_product`)."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_noop(df: DataFrame) -> None:
    """Execute the full plan without storing the result (benchmarking)."""
    df.write.format("noop").mode("overwrite").save()


def _file_system(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(conf), target


def switch(spark: SparkSession, base: str, run: str) -> None:
    """Make `run` the current run of `base`: a small text file is written
    aside and renamed over the former one, which readers see at once."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    aside = jvm.org.apache.hadoop.fs.Path(f"{base}/{_ASIDE}{run}")
    current = jvm.org.apache.hadoop.fs.Path(f"{base}/{_POINTER}")
    fs = current.getFileSystem(conf)
    out = fs.create(aside, True)
    out.write(bytearray(run.encode()))
    out.close()
    option = jvm.org.apache.hadoop.fs.Options.Rename
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(current.toUri(), conf) if current.toUri().getScheme() else jvm.org.apache.hadoop.fs.FileContext.getFileContext(conf)
    options = spark.sparkContext._gateway.new_array(option, 1)
    options[0] = option.OVERWRITE
    context.rename(fs.makeQualified(aside), fs.makeQualified(current), options)


def current_run(spark: SparkSession, base: str) -> str:
    """The folder of the current run of `base`."""
    name = spark.read.text(f"{base}/{_POINTER}").first()[0]
    return f"{base}/{name}"


def expire_runs(spark: SparkSession, base: str, older_than: dt.timedelta, keep: int = 1, now: dt.datetime | None = None) -> list[str]:
    """Delete the run folders of `base` that are not current, were last
    written to longer ago than `older_than` and are not among the `keep`
    latest, with what an interrupted switch left; returns their names. The age
    must exceed what a run, or a reader of one, takes."""
    fs, folder = _file_system(spark, base)
    if not fs.exists(folder):
        return []
    latest_first = sorted(fs.listStatus(folder), key=lambda s: -s.getModificationTime())
    now_ms = (now or dt.datetime.now(dt.timezone.utc)).timestamp() * 1000
    old = {s.getPath().getName(): now_ms - s.getModificationTime() > older_than.total_seconds() * 1000 for s in latest_first}
    runs = [s.getPath() for s in latest_first if s.getPath().getName().startswith(RUN_PREFIX)]
    current = current_run(spark, base).rsplit("/", 1)[1] if any(n == _POINTER for n in old) else None
    gone = [p for p in runs[keep:] if old[p.getName()] and p.getName() != current]
    asides = [s.getPath() for s in latest_first if s.getPath().getName().startswith(_ASIDE) and old[s.getPath().getName()]]
    for p in gone + asides:
        fs.delete(p, True)
    return sorted(p.getName() for p in gone)
