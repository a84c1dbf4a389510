"""Text sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_text_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per UTF-8 text file: ``doc_id`` (its path) and ``text``. A missing path raises."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("doc_id"), F.col("value").alias("text")
    )
