"""From raw documents to packed training sequences, in five stages.

Each stage takes what the one before kept, written to the shared folder and
read again, and its decisions take effect: what it rejects goes, what it cuts is
cut. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from voltalake.llm import decontamination, near_duplicates, packing, resampling, suffix_dedup
from voltalake.session import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
# Rows of an Arrow batch, and of a batch that a scan reads. Texts are long, and a batch
# is held several times over, by the executor's process and by its Python worker.
BATCH_ROWS = "1000"


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", BATCH_ROWS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the importance sample."""
    small_batches(spark)
    return resampling.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    small_batches(spark)
    return near_duplicates.without_copies(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that a smaller id has too."""
    small_batches(spark)
    return suffix_dedup.without_repeats(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    small_batches(spark)
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences."""
    small_batches(spark)
    return packing.pack(docs, str(public_tokenizers.path("byte_bpe_50k.json")))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_dedup),
    ("suffix-array dedup", substrings),
    ("benchmark decontamination", decontaminate),
    ("best-fit packing", pack),
]

# No stage can be put in SQL as a whole; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, function) in enumerate(STAGES):
        rows = stage(function(spark, rows, sf_dir), f"stage-{k}")
    return rows
