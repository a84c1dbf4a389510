"""A corpus pipeline: quality filter, near-duplicates, repeats, benchmark passages, tokens.

Each stage is a function of (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet and read again as the next stage's ``docs``. All but the last return the
columns of ``documents``; ``n_chars`` follows the text where a stage changes it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlake.llm.bpe import decode, encode, public_tokenizer
from fieldlake.llm.common import documents, drop, stored
from fieldlake.llm.decontaminate import contamination, without_spans
from fieldlake.llm.quality import score_quality
from fieldlake.llm.repeats import remove_repeats, whole_characters
from fieldlake.llm.simhash import near_duplicates
from fieldlake.operators.ranges import record_hash

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
BESIDE = ("lang", "source", "n_chars")


def _counted(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_chars`` of the text where that changed: null where the text is null."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def _marked(docs: DataFrame) -> DataFrame:
    """``docs`` with a hash of the whole row: rows are told apart by it, whether or not they have an id."""
    docs = docs.select(*COLUMNS)
    return docs.withColumn("mark", record_hash(docs))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from all labels, does not reject.

    Each row is judged by its own text, null as empty; rows that share an id, or have none, are
    judged apart. Equal rows share a verdict. Without labels nothing is rejected.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    marked = _marked(docs)
    scored = score_quality(marked, labels, F.lit(False), ("mark",))
    rejected = scored.filter("score < 0.5").select("mark").distinct()
    return marked.join(rejected, "mark", "left_anti").select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the row with the least id, any id before a null one.

    Of several rows with that id the one of the least row hash stays, and of equal rows one.
    Rows of one id whose texts are not alike are in different groups and all stay. Null and
    empty texts are alike.
    """
    marked = _marked(docs)
    groups = near_duplicates(marked, 3, 2, ("mark",))
    candidates = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = (
        candidates.groupBy("component", "mark")
        .agg(F.count("*").alias("copies"))
        .groupBy("component")
        .agg(F.min(F.struct("mark", "copies")).alias("first"))
    )
    kept, _ = stored(first.select("first.*"), "first-of-groups")
    once = marked.join(kept.filter("copies = 1"), "mark", "left_semi")
    equal = marked.join(kept.filter("copies > 1"), "mark", "left_semi").dropDuplicates(["mark"])
    return once.union(equal).select(*COLUMNS)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of 50-byte strings that start in an earlier document.

    A cut can fall inside a character; what is left of it goes too, so texts stay UTF-8. Rows
    with a null id are after all others and alike; rows of one id do not cut each other. A text
    that is cut whole stays as an empty one, and a null text becomes empty.
    """
    return _counted(whole_characters(remove_repeats(docs, 50, BESIDE)))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the merged spans of benchmark windows of 10 words.

    All rows stay, with or without an id. Items with a null id cut like others; null items, and
    an empty benchmark, cut nothing.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    found = contamination(docs, benchmark, 10, BESIDE)
    return _counted(without_spans(found))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and whether the ids decode to the text (null as empty), for every row."""
    ranks, pattern = public_tokenizer()
    decoded = decode(encode(docs, ranks, pattern, ("text",)), ranks)
    same = F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("repeats", repeats),
    ("benchmark_passages", benchmark_passages),
    ("tokens", tokens),
]

#: Not expressible: trained scores, fingerprints and token ids are no SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each but the first reads what the one before has stored."""
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES:
        docs, path = stored(stage(spark, docs, sf_dir), f"stage-{name}")
        if before:
            drop(spark, before)
        before = path
    return docs
