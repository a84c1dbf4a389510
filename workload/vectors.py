"""Similarity search over ``embeddings`` and over embedded ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlake.functions.text import TOKEN
from fieldlake.operators.embeddings import embed_text
from fieldlake.operators.search import (
    build_index,
    recall_by_probes,
    search_index,
    search_index_batch,
    search_text,
    similar,
    similar_batch,
)
from fieldlake.session import scratch_path
from workload.registry import query
from workload.views import table

DIMENSION = 256
QUESTION = "the inoran rewh of 12 thatin"
TOP = 10


def _first_vector(items: DataFrame) -> DataFrame:
    return items.agg(F.min_by("embedding", "vec_id").alias("embedding"))


def _scored(found: DataFrame, *columns: str) -> DataFrame:
    return found.select(*columns, F.round("score", 6).alias("score"))


@query(
    f"""SELECT vec_id, "label", round(s, 6) AS score FROM (
      SELECT vec_id, "label", list_dot_product(embedding::DOUBLE[],
        (SELECT arg_min(embedding, vec_id) FROM embeddings)::DOUBLE[]) AS s FROM embeddings)
    ORDER BY round(s, 12) DESC, vec_id LIMIT {TOP}"""
)
def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "embeddings")
    return _scored(similar(items, _first_vector(items), TOP, "vec_id"), "vec_id", "label")


@query(
    f"""WITH q AS (SELECT "label" AS query_id, arg_min(embedding, vec_id) AS e
                   FROM embeddings GROUP BY 1),
    s AS (SELECT query_id, vec_id AS item_id,
                 list_dot_product(embedding::DOUBLE[], e::DOUBLE[]) AS s FROM embeddings, q)
    SELECT query_id, item_id, round(s, 6) AS score, CAST(r AS INTEGER) AS "rank" FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(s, 12) DESC, item_id) AS r
      FROM s) WHERE r <= {TOP}"""
)
def vector_topk_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest items of the first item of every label."""
    items = table(spark, sf_dir, "embeddings")
    queries = items.groupBy(F.col("label").alias("query_id")).agg(
        F.min_by("embedding", "vec_id").alias("embedding")
    )
    found = similar_batch(items, queries, TOP, "vec_id")
    return _scored(found, "query_id", "item_id", "rank")


@query(
    f"""WITH s AS (SELECT q.vec_id AS query_id, i.vec_id AS item_id,
                 list_dot_product(i.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS s
                 FROM embeddings i, embeddings q)
    SELECT 'v' || query_id AS query_id, 'v' || item_id AS item_id, round(s, 6) AS score,
           CAST(r AS INTEGER) AS "rank" FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(s, 12) DESC, 'v' || item_id) AS r
      FROM s) WHERE r <= 3"""
)
def vector_self_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest items of every item, under text ids; queries without a vector find nothing."""
    name = F.concat(F.lit("v"), F.col("vec_id").cast("string"))
    items = table(spark, sf_dir, "embeddings").select(name.alias("vec_id"), "embedding")
    empty = items.select(F.concat(F.lit("none "), "vec_id").alias("vec_id"), F.lit(None).cast("array<float>").alias("embedding"))
    queries = items.union(empty).withColumnRenamed("vec_id", "query_id")
    return _scored(similar_batch(items, queries, 3, "vec_id"), "query_id", "item_id", "rank")


@query(
    f"""WITH texts AS (SELECT doc_id, text FROM documents
                       UNION ALL SELECT -1, '{QUESTION}'),
    tokens AS (SELECT doc_id, ('0x' || substr(md5(t), 1, 8))::BIGINT AS h FROM (
      SELECT doc_id, unnest(regexp_extract_all(lower(text), '({TOKEN})', 1)) AS t FROM texts)),
    sums AS (SELECT doc_id, h % {DIMENSION} AS b,
      CAST(sum(CASE WHEN (h // {DIMENSION}) % 2 = 1 THEN -1 ELSE 1 END) AS DOUBLE) AS v
      FROM tokens GROUP BY 1, 2),
    norms AS (SELECT doc_id, sqrt(sum(v * v)) AS n FROM sums GROUP BY 1),
    vectors AS (SELECT doc_id, b, CAST(CAST(v / CASE WHEN n = 0 THEN 1 ELSE n END AS FLOAT)
                AS DOUBLE) AS v FROM sums JOIN norms USING (doc_id)),
    scores AS (SELECT d.doc_id, sum(d.v * q.v) AS s FROM vectors d
               JOIN vectors q ON q.b = d.b AND q.doc_id = -1 WHERE d.doc_id <> -1 GROUP BY 1)
    SELECT doc_id, round(s, 6) AS score FROM scores
    ORDER BY round(s, 12) DESC, doc_id LIMIT {TOP}"""
)
def text_embedding_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    embedded = embed_text(documents, dimension=DIMENSION)
    found = search_text(embedded, QUESTION, TOP, "doc_id", dimension=DIMENSION)
    return _scored(found, "doc_id")


_NEAREST = f"""SELECT vec_id, "label", round(s, 6) AS score FROM (
      SELECT vec_id, "label", list_dot_product(embedding::DOUBLE[],
        (SELECT arg_min(embedding, vec_id) FROM embeddings)::DOUBLE[]) AS s FROM embeddings)
    ORDER BY round(s, 12) DESC, vec_id LIMIT {TOP}"""


@query(_NEAREST)
def ivf_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Through the clustered index, from the cells that may hold one of the nearest."""
    items = table(spark, sf_dir, "embeddings")
    path = build_index(items, scratch_path(spark, "index"))
    found = search_index(spark, path, _first_vector(items), TOP, item_id="vec_id")
    return _scored(found, "vec_id", "label")


def _asking(items: DataFrame) -> DataFrame:
    return items.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")


@query(
    f"""WITH s AS (SELECT q.vec_id AS query_id, i.vec_id AS item_id,
                 list_dot_product(i.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS s
                 FROM embeddings i JOIN embeddings q ON q.vec_id % 50 = 0)
    SELECT query_id, item_id, round(s, 6) AS score, CAST(r AS INTEGER) AS "rank" FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(s, 12) DESC, item_id) AS r
      FROM s) WHERE r <= {TOP}"""
)
def ivf_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch of queries through the clustered index, each in the cells it needs."""
    items = table(spark, sf_dir, "embeddings")
    path = build_index(items, scratch_path(spark, "index"))
    found = search_index_batch(spark, path, _asking(items), TOP, item_id="vec_id")
    return _scored(found, "query_id", "item_id", "rank")


@query()
def ivf_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recall by the number of cells probed; it depends on the clusters, so without SQL."""
    items = table(spark, sf_dir, "embeddings")
    path = build_index(items, scratch_path(spark, "index"))
    found = recall_by_probes(spark, path, _asking(items), TOP, item_id="vec_id")
    return found.select("probes", F.round("recall", 6).alias("recall"))


@query(_NEAREST)
def ivf_all_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Through the clustered index with all cells probed, which is the exact result."""
    items = table(spark, sf_dir, "embeddings")
    path = build_index(items, scratch_path(spark, "index"), cells=8)
    found = search_index(spark, path, _first_vector(items), TOP, 8, "vec_id")
    return _scored(found, "vec_id", "label")
