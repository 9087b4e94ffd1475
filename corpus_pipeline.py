"""From raw documents to packed token sequences: five stages, each over all its predecessor kept.

Every stage is written as Parquet and read again as the next one's input, so a lost executor costs a stage's
tasks at most. All but the last keep the columns of ``documents``. Null texts count as empty, rows that repeat
are judged one by one, and an empty table passes through as an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm import decontam, jaccard, packing, quality, secret_scan
from ledgermill.llm.frames import cut

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that the compression classifier does not reject."""
    return quality.accepted(docs, _table(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, that with the smallest doc_id."""
    row = "_row_of_pipeline"
    # Written once, so that the row numbers hold in every job, also after an executor is lost.
    numbered = cut(docs.withColumn(row, F.monotonically_increasing_id()))
    ids = numbered.select(row, "doc_id")
    groups = jaccard.near_duplicates(numbered.select(F.col(row).alias("doc_id"), "text"))
    kept = (
        groups.select(F.col("doc_id").alias(row), F.col("component_id").alias("component")).join(ids, row)
        .groupBy("component")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", row)).alias("first"))
        .select(F.col(f"first.{row}").alias(row))
    )
    return numbered.join(kept, row, "left_semi").drop(row)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that contain no benchmark item, re-parameterised or not."""
    return decontam.keep_clean(docs, _table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps all documents, their secrets masked."""
    return secret_scan.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("best-fit packing", packed),
]

# Trained models and tokenisation have no SQL form; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
