"""Text files into concept rows and business insights."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from fieldlake.operators.text_analysis import (
    Lexicon,
    analyse,
    business_insights,
    concept_dataset,
)
from fieldlake.sources.catalogue import applications
from fieldlake.sources.documents import read_text_files


@dataclass
class DocumentAnalysis:
    analysis: DataFrame
    concept_rows: DataFrame
    insights: DataFrame


def analyse_documents(
    documents: DataFrame,
    catalogue: DataFrame | None = None,
    lexicon: Lexicon = Lexicon(),
    as_of: Column | None = None,
    key: str = "doc_id",
) -> DocumentAnalysis:
    """Analysis, concept dataset and insights of a corpus with columns ``key`` and ``text``."""
    entries = applications(documents.sparkSession) if catalogue is None else catalogue
    analysis = analyse(documents, entries, lexicon, key=key)
    return DocumentAnalysis(
        analysis,
        concept_dataset(analysis, entries, as_of, key),
        business_insights(analysis, as_of, key),
    )


def analyse_files(spark: SparkSession, path: str, **options) -> DocumentAnalysis:
    """The same for a text file or a folder of them."""
    return analyse_documents(read_text_files(spark, path), **options)
