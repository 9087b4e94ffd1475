"""Attachment files with their extracted text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import join_pages


def scan_files(spark: SparkSession, path: str) -> DataFrame:
    """Attachment files by name with their bytes."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(
        F.substring_index("path", "/", -1).alias("filename"), "length", "content"
    )


def document_text(documents: DataFrame) -> DataFrame:
    """One text per document from its array of page texts."""
    return documents.select("filename", join_pages(F.col("pages")).alias("text"))
