"""From raw documents to packed training sequences.

STAGES in order: documents graded toxic go; of each class of near copies one
document stays; words covered by a window of 13 words that also starts in a
document with a smaller id are cut; documents that contain a benchmark item
go; what is left is tokenized and packed. Each stage works on all rows of the
one before, written as Parquet and read again; all but the last return the
columns they were given. A stage first deletes the work tables of the stage
before, whose result is written by then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recurra.llm.common import documents, drop_stages, stage_path, stages_written, table
from recurra.llm.decontamination import drop_contaminated
from recurra.llm.jaccard import keep_one_of_each
from recurra.llm.packing import pack
from recurra.llm.substrings import cut_documents
from recurra.llm.toxicity import drop_toxic, fit_toxicity

#: Stage tables of whatever ran before the pipeline are left alone.
_before: dict[str, int] = {}


def _start(spark: SparkSession) -> None:
    app = spark.sparkContext.applicationId
    drop_stages(spark, _before.get(app, stages_written()))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _before[spark.sparkContext.applicationId] = stages_written()
    return drop_toxic(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _start(spark)
    return keep_one_of_each(docs)


def repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _start(spark)
    return cut_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _start(spark)
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _start(spark)
    return pack(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "tier", "step_group"
    )


STAGES = [
    ("toxicity", toxicity),
    ("jaccard_join", near_duplicates),
    ("substring_dedup", repeated_substrings),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: A fitted model and a tokenizer are no SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, function in STAGES[:-1]:
        path = stage_path(spark, f"pipeline-{name}")
        function(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
