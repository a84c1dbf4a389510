"""Text analysis over ``documents``, whole texts, with word lists taken from their vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlake.functions.text import find_all, phrase_patterns, word_count
from fieldlake.operators import text_analysis as ta
from fieldlake.operators.aggregates import count_elements
from fieldlake.sources.catalogue import APPLICATIONS, applications
from workload.registry import joined, query, rounded
from workload.views import table

LEXICON = ta.Lexicon(
    stem="inoran",
    concepts=["inoran", "hehely", "orantion", "rewh", "ononst", "of the", "and the", "que la",
              "die der", "trement", "êtreê", "éaument", "thanthe", "von der", "in the",
              "to the", "les des", "ouier", "reaux", "erblest", "retitioning"],
    business=["thatin", "orre", "inoran", "hehely", "ononst", "orantion", "rewh", "blest",
              "ndhan", "terion", "enenwh", "ouier", "ieron", "ouren", "ation"],
    complexity={3: ["inoran", "ononst the", "erblest", "rewhth"],
                2: ["orantion", "hehely", "retit"],
                1: ["of the", "que", "und"]},
    positive=["rewh", "thatin", "orre", "tionre", "oration", "shes"],
    negative=["ononst", "hehely", "inanen", "ouleun", "enaux", "nderth"],
)
CATALOGUE_TOKENS = 6


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def _catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalogue from ``benchmark``: its texts are the descriptions."""
    item = F.col("item_id")
    domains = [F.concat(F.lit("domain_"), item % 6), F.concat(F.lit("domain_"), item % 4)]
    return table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("item_"), item).alias("name"),
        F.col("text").alias("description"),
        F.array_sort(F.array_distinct(F.array(*domains))).alias("domains"),
        F.element_at(F.array(F.lit("low"), F.lit("medium"), F.lit("high")), (item % 3 + 1).cast("int"))
        .alias("market_potential"),
    )


def _quoted(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def _present(words) -> str:
    return f"list_filter({_quoted(words)}, lambda k: contains(lower(text), k))"


def _count(words) -> str:
    return f"len({_present(words)})"


_PHRASES = [f"regexp_extract_all(text, '(?i)({p})', 1)" for p in phrase_patterns(LEXICON.stem)]
_CONCEPTS = (
    f"list_sort(list_distinct(list_concat({_present(LEXICON.concepts)}, "
    f"list_concat({_PHRASES[0]}, {_PHRASES[1]}))))"
)
_WORDS = r"len(regexp_extract_all(text, '[^\s\x0b\x1c-\x1f\x85\p{Z}]+'))"
_COMPLEX = " + ".join(f"{w} * {_count(t)}" for w, t in LEXICON.complexity.items())
_MOST = sum(w * len(t) for w, t in LEXICON.complexity.items())

ANALYSED = f"""
analysed AS (
  SELECT doc_id, {_CONCEPTS} AS concepts,
    CAST({_count(LEXICON.business)} AS DOUBLE) / {len(LEXICON.business)} AS business_score,
    least(CAST({_COMPLEX} AS DOUBLE) / {_MOST}, 1.0) AS complexity_score,
    CASE WHEN {_WORDS} = 0 THEN 0.0::DOUBLE ELSE greatest(-1.0, least(1.0,
      CAST({_count(LEXICON.positive)} - {_count(LEXICON.negative)} AS DOUBLE) / {_WORDS})) END
      AS sentiment_score
  FROM documents),
scored AS (
  SELECT *, CASE WHEN business_score > 0.7 THEN 'high' WHEN business_score > 0.4 THEN 'medium'
            ELSE 'low' END AS market_potential FROM analysed)
"""

CATALOGUE = """
catalogue AS (
  SELECT 'item_' || item_id AS name, text AS description,
         list_sort(list_distinct(['domain_' || (item_id % 6), 'domain_' || (item_id % 4)]))
           AS domains,
         ['low', 'medium', 'high'][item_id % 3 + 1] AS market_potential FROM benchmark)
"""

DEFAULT_CATALOGUE = "catalogue AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{name}', '{text}', {_quoted(domains)}, '{potential}')"
    for name, text, domains, potential in APPLICATIONS
) + ") AS t(name, description, domains, market_potential))"


def _matched_sql(min_length: int) -> str:
    return f"""
    mentions AS (SELECT DISTINCT doc_id, lower(c) AS concept
                 FROM (SELECT doc_id, unnest(concepts) AS c FROM scored)),
    tokens AS (SELECT DISTINCT name, token FROM (SELECT name,
                 unnest(regexp_split_to_array(trim(lower(description)), '\\s+')) AS token
                 FROM catalogue) WHERE length(token) >= {min_length}),
    named AS (SELECT DISTINCT concept, name FROM (SELECT DISTINCT concept FROM mentions)
              JOIN tokens ON contains(concept, token)),
    hits AS (SELECT DISTINCT doc_id, name FROM mentions JOIN named USING (concept)),
    matched AS (SELECT doc_id, list_sort(list(name)) AS applications,
                  list_sort(list_distinct(flatten(list(domains)))) AS domains
                FROM hits JOIN catalogue USING (name) GROUP BY 1),
    analysis AS (SELECT s.*, coalesce(applications, []) AS applications,
                   coalesce(domains, []) AS domains
                 FROM scored s LEFT JOIN matched USING (doc_id))"""


@query(
    f"""WITH {ANALYSED} SELECT doc_id, array_to_string(concepts, '|') AS concepts,
        CAST(len(concepts) AS INTEGER) AS n FROM analysed"""
)
def concepts_per_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ta.extract_concepts(_texts(spark, sf_dir), LEXICON)
    return found.select("doc_id", joined("concepts").alias("concepts"), F.size("concepts").alias("n"))


@query(
    f"""WITH {ANALYSED} SELECT doc_id, round(business_score, 6) AS business_score,
        round(complexity_score, 6) AS complexity_score,
        round(sentiment_score, 9) + 0.0 AS sentiment_score, market_potential FROM scored"""
)
def text_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = ta.score_texts(_texts(spark, sf_dir), LEXICON).drop("text")
    return scored.withColumns(
        {
            "business_score": F.round("business_score", 6),
            "complexity_score": F.round("complexity_score", 6),
            "sentiment_score": F.round("sentiment_score", 9) + F.lit(0.0),
        }
    )


@query(
    f"""SELECT doc_id, CAST({_WORDS} AS INTEGER) AS n_words, CAST(len({_PHRASES[0]}) AS INTEGER)
        AS n_phrases, array_to_string({_PHRASES[1]}, '|') AS before FROM documents"""
)
def text_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    after, before = [find_all(F.col("text"), p) for p in phrase_patterns(LEXICON.stem)]
    return _texts(spark, sf_dir).select(
        "doc_id",
        word_count(F.col("text")).alias("n_words"),
        F.size(after).alias("n_phrases"),
        joined(before).alias("before"),
    )


def _analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalogue = _catalogue(spark, sf_dir)
    return ta.analyse(
        _texts(spark, sf_dir), catalogue, LEXICON, min_token_length=CATALOGUE_TOKENS
    )


@query(
    f"""WITH {ANALYSED}, {CATALOGUE}, {_matched_sql(CATALOGUE_TOKENS)}
    SELECT doc_id, array_to_string(applications, '|') AS applications,
           array_to_string(domains, '|') AS domains FROM analysis"""
)
def application_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _analysis(spark, sf_dir)
    return found.select(
        "doc_id", joined("applications").alias("applications"), joined("domains").alias("domains")
    )


@query(
    f"""WITH {ANALYSED}, {CATALOGUE}, {_matched_sql(CATALOGUE_TOKENS)}
    SELECT doc_id AS row_id, CASE doc_id % 5 WHEN 0 THEN -1 WHEN 1 THEN 1 ELSE doc_id END AS shown_id,
           array_to_string(applications, '|') AS applications,
           array_to_string(domains, '|') AS domains FROM analysis"""
)
def application_match_edge_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row has its own match where ids are missing or repeated."""
    texts = _texts(spark, sf_dir).withColumn("row_id", F.col("doc_id"))
    place = F.col("doc_id") % 5
    texts = texts.withColumn("doc_id", F.when(place == 1, 1).when(place != 0, F.col("doc_id")))
    analysed = ta.extract_concepts(texts, LEXICON)
    found = ta.match_applications(analysed, _catalogue(spark, sf_dir), CATALOGUE_TOKENS)
    return found.select(
        "row_id",
        F.coalesce("doc_id", F.lit(-1).cast("long")).alias("shown_id"),
        joined("applications").alias("applications"),
        joined("domains").alias("domains"),
    )


@query(
    f"""WITH {ANALYSED}, {DEFAULT_CATALOGUE}, {_matched_sql(1)}
    SELECT domain, count(*) AS n FROM (SELECT unnest(domains) AS domain FROM analysis) GROUP BY 1"""
)
def domain_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents per domain of the built-in catalogue."""
    found = ta.match_applications(
        ta.extract_concepts(_texts(spark, sf_dir), LEXICON), applications(spark)
    )
    return count_elements(found, "domains", "domain")


_STAMP = "'2024-01-31T00:00:00Z'"


@query(
    f"""WITH {ANALYSED}, {CATALOGUE}, {_matched_sql(CATALOGUE_TOKENS)}
    SELECT doc_id, 'concept_' || (i - 1) AS id, 'quantum_concept' AS "type",
      concepts[i] AS text, round(complexity_score, 6) AS complexity_score, market_potential,
      round(sentiment_score, 9) + 0.0 AS sentiment_score,
      array_to_string(domains, '|') AS business_domains, {_STAMP} AS "timestamp"
    FROM (SELECT *, unnest(range(1, len(concepts) + 1)) AS i FROM analysis)
    UNION ALL
    SELECT doc_id, 'app_' || (i - 1), 'quantum_application', c.description,
      round(complexity_score, 6), c.market_potential, round(sentiment_score, 9) + 0.0,
      array_to_string(c.domains, '|'), {_STAMP}
    FROM (SELECT *, unnest(range(1, len(applications) + 1)) AS i FROM analysis) a
    JOIN catalogue c ON c.name = a.applications[i]"""
)
def concept_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_of = F.to_timestamp(F.lit("2024-01-31 00:00:00"))
    rows = ta.concept_dataset(_analysis(spark, sf_dir), _catalogue(spark, sf_dir), as_of)
    return rows.withColumns(
        {
            "complexity_score": F.round("complexity_score", 6),
            "sentiment_score": F.round("sentiment_score", 9) + F.lit(0.0),
            "business_domains": joined("business_domains"),
        }
    )


@query(
    f"""WITH {ANALYSED}, {CATALOGUE}, {_matched_sql(CATALOGUE_TOKENS)}
    SELECT doc_id, 'quantum_market_analysis' AS insight_id, 'market_analysis' AS insight_type,
      'Quantum sensor market analysis with ' || len(concepts) || ' concepts identified'
        AS description, market_potential,
      CASE WHEN complexity_score > 0.7 THEN 'high' WHEN complexity_score > 0.4 THEN 'medium'
           ELSE 'low' END AS complexity_level,
      CASE WHEN len(domains) = 0 THEN '[]'
           ELSE '["' || array_to_string(domains, '","') || '"]' END AS business_domains,
      round(sentiment_score, 9) + 0.0 AS confidence_score, {_STAMP} AS "timestamp"
    FROM analysis"""
)
def document_insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_of = F.to_timestamp(F.lit("2024-01-31 00:00:00"))
    insights = ta.business_insights(_analysis(spark, sf_dir), as_of)
    return ta.with_json_lists(insights, "business_domains").withColumn(
        "confidence_score", F.round("confidence_score", 9) + F.lit(0.0)
    )
