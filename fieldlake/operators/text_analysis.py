"""Concepts, scores and application matches of documents.

A document is analysed in one narrow pass over its whole text; the catalogue travels as a small
array next to it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlake.functions.numeric import level
from fieldlake.functions.temporal import iso_text
from fieldlake.functions.text import (
    count_present,
    find_all,
    phrase_patterns,
    present_keywords,
    word_count,
)
from fieldlake.session import broadcast_if_small, materialise

CATALOGUE_BOUND = 10_000


@dataclass(frozen=True)
class Lexicon:
    """Word lists of the analysis. The defaults are fixed values."""

    stem: str = "quantum"
    concepts: list[str] = field(
        default_factory=lambda: [
            "quantum",
            "sensor",
            "interferometry",
            "entanglement",
            "superposition",
            "coherence",
            "decoherence",
            "qubit",
            "quantum computing",
            "quantum mechanics",
            "quantum optics",
            "quantum field",
            "quantum state",
            "quantum algorithm",
            "quantum advantage",
            "quantum supremacy",
            "quantum error correction",
            "quantum annealing",
            "adiabatic",
            "variational",
            "optimization",
        ]
    )
    business: list[str] = field(
        default_factory=lambda: [
            "market",
            "commercial",
            "business",
            "industry",
            "application",
            "revenue",
            "profit",
            "investment",
            "funding",
            "startup",
            "enterprise",
            "customer",
            "product",
            "service",
            "solution",
        ]
    )
    complexity: dict[int, list[str]] = field(
        default_factory=lambda: {
            3: ["quantum supremacy", "error correction", "coherence", "entanglement"],
            2: ["quantum computing", "quantum algorithm", "optimization"],
            1: ["quantum sensor", "quantum optics", "quantum field"],
        }
    )
    positive: list[str] = field(
        default_factory=lambda: [
            "breakthrough",
            "innovation",
            "potential",
            "advancement",
            "revolutionary",
            "promising",
        ]
    )
    negative: list[str] = field(
        default_factory=lambda: [
            "challenge",
            "difficult",
            "limitation",
            "barrier",
            "complex",
            "expensive",
        ]
    )


def concepts(text: Column, lowered: Column, lexicon: Lexicon) -> Column:
    """Sorted distinct keywords and phrases around the stem.

    Keywords are lower case, phrases keep the case they are written in.
    """
    phrases = [find_all(text, pattern) for pattern in phrase_patterns(lexicon.stem)]
    found = F.concat(present_keywords(lowered, lexicon.concepts), *phrases)
    return F.array_sort(F.array_distinct(found))


def business_score(lowered: Column, lexicon: Lexicon) -> Column:
    if not lexicon.business:
        return F.lit(0.0)
    return count_present(lowered, lexicon.business) / F.lit(float(len(lexicon.business)))


def complexity_score(lowered: Column, lexicon: Lexicon) -> Column:
    """Weighted share of the complexity terms that occur."""
    most = sum(weight * len(terms) for weight, terms in lexicon.complexity.items())
    if not most:
        return F.lit(0.0)
    total: Column = F.lit(0)
    for weight, terms in lexicon.complexity.items():
        total = total + count_present(lowered, terms) * weight
    return F.least(total / F.lit(float(most)), F.lit(1.0))


def sentiment_score(text: Column, lowered: Column, lexicon: Lexicon) -> Column:
    """(positive - negative) per word, within -1 and 1; 0 for a text without words."""
    words = word_count(text)
    balance = count_present(lowered, lexicon.positive) - count_present(lowered, lexicon.negative)
    bounded = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), balance / words))
    return F.when(words == 0, F.lit(0.0)).otherwise(bounded)


def extract_concepts(
    documents: DataFrame, lexicon: Lexicon = Lexicon(), text: str = "text"
) -> DataFrame:
    """Add ``concepts``."""
    column = F.col(text)
    return documents.withColumn("concepts", concepts(column, F.lower(column), lexicon))


def score_texts(
    documents: DataFrame, lexicon: Lexicon = Lexicon(), text: str = "text"
) -> DataFrame:
    """Add ``business_score, market_potential, complexity_score, sentiment_score``."""
    lowered = documents.withColumn("_lower", F.lower(text))
    low = F.col("_lower")
    scored = lowered.withColumns(
        {
            "business_score": business_score(low, lexicon),
            "complexity_score": complexity_score(low, lexicon),
            "sentiment_score": sentiment_score(F.col(text), low, lexicon),
        }
    )
    return scored.withColumn("market_potential", level(F.col("business_score"))).drop("_lower")


def _description_tokens(description: Column) -> Column:
    words = F.split(F.trim(F.lower(description)), r"\s+")
    return F.array_distinct(F.filter(words, lambda w: w != ""))


def _kept_tokens(catalogue: DataFrame, min_token_length: int) -> DataFrame:
    tokens = F.filter(
        _description_tokens(F.col("description")), lambda t: F.length(t) >= min_token_length
    )
    return catalogue.select("name", "domains", tokens.alias("tokens"))


def match_applications(
    analysed: DataFrame,
    catalogue: DataFrame,
    min_token_length: int = 1,
) -> DataFrame:
    """Add ``applications`` and ``domains``: catalogue entries any of whose description words is
    a substring of any concept, and the union of their domains.

    Stop words in a description match broadly; ``min_token_length`` narrows that. Every row has its
    own match, whatever its id, and entries of one name all count.

    The substring match is an equi-join: a token is in a concept if it equals one of the concept's
    substrings of its length. Distinct concepts are cut up, not every mention, and each gets its
    entries as one list. The rows are stored first, because they are used twice and came from
    whole texts.
    """
    rows = materialise(analysed.withColumn("_row", F.monotonically_increasing_id()), "analysed")
    entries = _kept_tokens(catalogue, min_token_length)
    tokens = entries.select(F.struct("name", "domains").alias("entry"), F.explode("tokens").alias("token")).distinct()
    lengths = tokens.agg(F.collect_set(F.length("token")).alias("lengths")).scalar()
    mentions = rows.select("_row", F.explode("concepts").alias("concept"))
    mentions = mentions.select("_row", F.lower("concept").alias("concept"))
    pieces = (
        mentions.select("concept")
        .distinct()
        .withColumn("_length", F.explode(lengths))
        .filter(F.col("_length") <= F.length("concept"))
        .withColumn(
            "_start", F.explode(F.sequence(F.lit(1), F.length("concept") - F.col("_length") + 1))
        )
        .select("concept", F.substring("concept", F.col("_start"), F.col("_length")).alias("token"))
    )
    named = pieces.join(tokens, "token").groupBy("concept").agg(F.collect_set("entry").alias("entries"))
    matched = (
        mentions.join(named, "concept")
        .groupBy("_row")
        .agg(F.array_distinct(F.flatten(F.collect_list("entries"))).alias("_entries"))
    )
    empty = F.array().cast("array<string>")
    names, domains = F.col("_entries.name"), F.flatten("_entries.domains")
    return (
        rows.join(matched, "_row", "left")
        .withColumns(
            {
                "applications": F.coalesce(F.array_sort(F.array_distinct(names)), empty),
                "domains": F.coalesce(F.array_sort(F.array_distinct(domains)), empty),
            }
        )
        .drop("_row", "_entries")
    )


def analyse(
    documents: DataFrame,
    catalogue: DataFrame,
    lexicon: Lexicon = Lexicon(),
    text: str = "text",
    key: str = "doc_id",
    min_token_length: int = 1,
) -> DataFrame:
    """Concepts, scores, applications and domains of every document; the text is left behind."""
    scored = score_texts(extract_concepts(documents, lexicon, text), lexicon, text).drop(text)
    matched = match_applications(scored, catalogue, min_token_length)
    return matched.select(
        key,
        "concepts",
        "applications",
        "complexity_score",
        "market_potential",
        "domains",
        "sentiment_score",
    )


def concept_dataset(
    analysis: DataFrame, catalogue: DataFrame, as_of: Column | None = None, key: str = "doc_id"
) -> DataFrame:
    """One row per concept with the document's scores, and one per matched application with the
    catalogue's description, potential and domains. Ids count from 0 within a document.

    Both kinds are unfolded from one row, so a document is analysed once.
    """
    time = iso_text(F.current_timestamp() if as_of is None else as_of)

    def item(prefix: str, kind: str, position: Column, text: Column, name: Column) -> Column:
        return F.struct(
            F.concat(F.lit(prefix), position).alias("id"),
            F.lit(kind).alias("type"),
            text.alias("_concept"),
            name.alias("_name"),
        )

    nothing = F.lit(None).cast("string")
    items = F.concat(
        F.transform("concepts", lambda c, i: item("concept_", "quantum_concept", i, c, nothing)),
        F.transform("applications", lambda a, i: item("app_", "quantum_application", i, nothing, a)),
    )
    unfolded = analysis.select(
        key,
        "complexity_score",
        "market_potential",
        "sentiment_score",
        "domains",
        F.inline_outer(items),
    )
    entries = catalogue.select(
        F.col("name").alias("_name"),
        F.col("description").alias("_description"),
        F.col("domains").alias("_domains"),
        F.col("market_potential").alias("_potential"),
    )
    is_concept = F.col("_concept").isNotNull()
    detailed = unfolded.join(broadcast_if_small(entries, CATALOGUE_BOUND), "_name", "left")
    return detailed.filter(is_concept | F.col("_description").isNotNull()).select(
        key,
        "id",
        "type",
        F.coalesce("_concept", "_description").alias("text"),
        "complexity_score",
        F.when(is_concept, F.col("market_potential")).otherwise(F.col("_potential"))
        .alias("market_potential"),
        "sentiment_score",
        F.when(is_concept, F.col("domains")).otherwise(F.col("_domains")).alias("business_domains"),
        time.alias("timestamp"),
    )


def business_insights(
    analysis: DataFrame, as_of: Column | None = None, key: str = "doc_id"
) -> DataFrame:
    """One market-analysis row per document."""
    time = iso_text(F.current_timestamp() if as_of is None else as_of)
    return analysis.select(
        key,
        F.lit("quantum_market_analysis").alias("insight_id"),
        F.lit("market_analysis").alias("insight_type"),
        F.format_string(
            "Quantum sensor market analysis with %d concepts identified", F.size("concepts")
        ).alias("description"),
        "market_potential",
        level(F.col("complexity_score")).alias("complexity_level"),
        F.col("domains").alias("business_domains"),
        F.col("sentiment_score").alias("confidence_score"),
        time.alias("timestamp"),
    )


def with_json_lists(df: DataFrame, *columns: str) -> DataFrame:
    """Array columns as JSON text, for sinks without arrays."""
    return df.withColumns({c: F.to_json(c) for c in columns})
