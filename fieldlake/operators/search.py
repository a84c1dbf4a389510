"""Similarity search: exact top-k by dot product, in batches, and over an inverted-file index."""

from __future__ import annotations

import logging
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldlake.functions.numeric import dot
from fieldlake.operators.cells import (
    SAMPLE,
    SLACK,
    Cells,
    assigned,
    cell_sizes,
    cells_for,
    cells_of,
    centres_of,
    join_by_cell,
    matrix,
    query_kernel,
    sample_of,
    usable,
)
from fieldlake.operators.embeddings import DIMENSION, embed_text
from fieldlake.operators.rows import top_n
from fieldlake.session import materialise

log = logging.getLogger(__name__)

#: Items per cell that the centres of an index are fitted to.
FIT_ROWS = 256


def similar(
    items: DataFrame,
    query: DataFrame,
    k: int = 5,
    item_id: str = "id",
    vector: str = "embedding",
) -> DataFrame:
    """All columns of the ``k`` items with the largest dot product, and their ``score``.

    ``query`` is one row with the query vector. It reaches the scan as a constant, every task
    keeps its best ``k``. Scores that agree in 12 decimals tie, and the smaller id comes first.
    """
    scored = _with_score(items, vector, query, vector)
    return top_n(scored, [F.desc(F.round("score", 12)), F.asc(item_id)], k)


def _with_score(items: DataFrame, vector: str, query: DataFrame, query_vector: str) -> DataFrame:
    target = items.withColumn("_query", query.select(query_vector).scalar())
    return target.withColumn("score", dot(F.col(vector), F.col("_query"))).drop("_query")


def search_text(
    items: DataFrame,
    text: str,
    k: int = 5,
    item_id: str = "id",
    vector: str = "embedding",
    dimension: int = DIMENSION,
    index: str | None = None,
) -> DataFrame:
    """The items most similar to a text, embedded the same way as the items were."""
    words = items.sparkSession.createDataFrame([(text,)], "text string")
    query = embed_text(words, "text", dimension, vector)
    return search(items, query, k, index, item_id=item_id, vector=vector)


def _named(df: DataFrame, row_id: str, vector: str, name: str) -> DataFrame:
    rows = df.select(F.col(row_id).alias(name), F.col(vector).cast("array<double>").alias("vector"))
    return rows.filter(usable(F.col("vector")))


def similar_batch(
    items: DataFrame,
    queries: DataFrame,
    k: int = 5,
    item_id: str = "id",
    query_id: str = "query_id",
    vector: str = "embedding",
) -> DataFrame:
    """``query_id, item_id, score, rank``: the ``k`` most similar items for every query.

    Items are dealt to cells and stored, and each query meets the cells that may hold one of
    its best. Scores that agree in 12 decimals are ordered by item. Items and queries whose
    vector is null or holds null or non-finite entries are left out; all others have one length.
    """
    spark = items.sparkSession
    things = _named(items, item_id, vector, "item_id")
    named = _named(queries, query_id, vector, "query_id")
    sample = sample_of(things, "vector")
    if not len(sample):
        kinds = f"query_id {dict(named.dtypes)['query_id']}, item_id {dict(things.dtypes)['item_id']}"
        return spark.createDataFrame([], f"{kinds}, score double, rank int")
    rows = len(sample) if len(sample) < SAMPLE else things.count()
    centres = centres_of(sample, cells_for(rows, spark.sparkContext.defaultParallelism))
    dealt = materialise(assigned(things, "vector", centres), "cells")
    found = join_by_cell(dealt, named, cells_of(centres, cell_sizes(dealt)), sample, k)
    return found.select("query_id", "item_id", "score", "rank")


def build_index(
    items: DataFrame,
    path: str,
    cells: int | None = None,
    vector: str = "embedding",
    seed: int = 42,
    iterations: int = 10,
) -> str:
    """Write the items in clusters, one partition folder each, with what bounds their scores.

    By default there are as many cells as the root of the number of items. Centres are fitted to
    the items with the least hashes, ``FIT_ROWS`` per cell at most; all items are written. The
    centres are stored with the radius and the number of items of each cell, and with a bounded
    sample of the vectors. Items whose vector is null or holds null or non-finite entries are in
    cell -1. The rebalance hint lets AQE split a large cell over several files.
    """
    spark = items.sparkSession
    with_vector = items.filter(usable(F.col(vector)))
    rows = with_vector.count()
    cells = cells or max(1, math.isqrt(max(0, rows - 1)) + 1)
    doubles = with_vector.withColumn(vector, F.col(vector).cast("array<double>"))
    centres = np.zeros((0, 0))
    if rows:
        share = min(1.0, FIT_ROWS * cells / rows)
        part = (F.pmod(F.xxhash64(vector), F.lit(1 << 20)) < math.ceil(share * (1 << 20))) | F.lit(share >= 1)
        features = doubles.filter(part).select(array_to_vector(F.col(vector)).alias("_features"))
        means = KMeans(k=cells, seed=seed, maxIter=iterations, featuresCol="_features", predictionCol="cell")
        # a sample without a row, as of few distinct vectors, leaves one centre
        fitted = features if share >= 1 or not features.isEmpty() else doubles.select(array_to_vector(F.col(vector)).alias("_features"))
        centres = np.array([c for c in means.fit(fitted).clusterCenters()])
    sample = sample_of(doubles, vector)
    placed = assigned(with_vector, vector, centres) if rows else with_vector.select(F.lit(0).alias("cell"), F.lit(0.0).alias("_distance"), "*")
    others = items.filter(~F.coalesce(usable(F.col(vector)), F.lit(False)))
    others = others.select(F.lit(-1).alias("cell"), F.lit(0.0).alias("_distance"), "*")
    placed.union(others).hint("rebalance", "cell").write.mode("overwrite").partitionBy("cell").parquet(f"{path}/items")
    stored = _items(spark, path) if rows or not others.isEmpty() else placed
    sizes = {row["cell"]: row for row in cell_sizes(stored).collect()}
    made = [
        (i, [float(x) for x in c], float(sizes[i]["radius"]) if i in sizes else 0.0, int(sizes[i]["rows"]) if i in sizes else 0)
        for i, c in enumerate(centres)
    ]
    if -1 in sizes:
        made.append((-1, None, None, int(sizes[-1]["rows"])))
    kinds = "cell int, centre array<double>, radius double, rows long"
    spark.createDataFrame(made, kinds).coalesce(1).write.mode("overwrite").parquet(f"{path}/centres")
    vectors = [(v.tolist(),) for v in sample]
    spark.createDataFrame(vectors, "vector array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/sample")
    return path


def _items(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/items")


def _cells(spark: SparkSession, path: str) -> Cells:
    """What the index knows of its cells; as few rows as cells."""
    rows = sorted(spark.read.parquet(f"{path}/centres").filter("cell >= 0").collect(), key=lambda row: row["cell"])
    return Cells(
        np.array([row["centre"] for row in rows]) if rows else np.zeros((0, 0)),
        np.array([row["radius"] for row in rows]),
        np.array([row["rows"] for row in rows], np.int64),
    )


def nearest_cells(spark: SparkSession, path: str, query: DataFrame, probes: int, vector: str) -> list:
    """Ids of the ``probes`` cells whose centres score highest; the centres are as few as cells."""
    centres = spark.read.parquet(f"{path}/centres").filter("cell >= 0")
    scored = _with_score(centres, "centre", query, vector)
    return [row["cell"] for row in top_n(scored, [F.desc("score"), F.asc("cell")], probes).collect()]


def needed_cells(
    spark: SparkSession, path: str, query: DataFrame, k: int, item_id: str, vector: str
) -> list[int] | None:
    """Cells that may hold one of the ``k`` best, the most promising first; None for all cells.

    The cells of highest bound that have ``k`` items between them are searched for a floor under
    the k-th best score; the others are needed only where their bound reaches it.
    """
    cells = _cells(spark, path)
    found = query.select(F.col(vector).cast("array<double>").alias("vector")).filter(usable(F.col("vector"))).first()
    if found is None or cells.rows.sum() < k:
        return None
    bounds = cells.bounds(np.array([found["vector"]]))[0]
    order = np.argsort(-bounds, kind="stable")
    first = order[: int(np.searchsorted(np.cumsum(cells.rows[order]), k)) + 1].tolist()
    some = _items(spark, path).filter(F.col("cell").isin(first))
    floor = similar(some, query, k, item_id, vector).agg(F.min(F.round("score", 12))).first()[0]
    size = 1 + float(np.linalg.norm(found["vector"])) * float((np.linalg.norm(cells.centres, axis=1) + cells.radius).max())
    return [int(cell) for cell in order if bounds[cell] >= floor - SLACK * size]


def search_index(
    spark: SparkSession,
    path: str,
    query: DataFrame,
    k: int = 5,
    probes: int | None = None,
    item_id: str = "id",
    vector: str = "embedding",
) -> DataFrame:
    """Top-k through the index: exact, from the cells that may hold one of the best.

    With ``probes``, only that many cells of highest centre score are read; the result is then
    approximate (see :func:`recall_by_probes`). Items without a usable vector are ranked as
    ``similar`` ranks them.
    """
    if probes is None:
        cells = needed_cells(spark, path, query, k, item_id, vector)
    else:
        cells = nearest_cells(spark, path, query, probes, vector)
    items = _items(spark, path).drop("_distance")
    candidates = items if cells is None else items.filter(F.col("cell").isin([-1, *cells]))
    return similar(candidates, query, k, item_id, vector)


def search_index_batch(
    spark: SparkSession,
    path: str,
    queries: DataFrame,
    k: int = 5,
    probes: int | None = None,
    item_id: str = "id",
    query_id: str = "query_id",
    vector: str = "embedding",
) -> DataFrame:
    """``query_id, item_id, score, cell, rank`` for every query, through the stored index.

    As :func:`similar_batch`, but the items have their cells already.
    """
    named = _named(queries, query_id, vector, "query_id")
    items = _items(spark, path).filter("cell >= 0")
    items = items.select("cell", F.col(item_id).alias("item_id"), F.col(vector).cast("array<double>").alias("vector"))
    sample = sample_of(spark.read.parquet(f"{path}/sample"), "vector")
    cells = _cells(spark, path)
    return join_by_cell(items, named if len(cells.rows) else named.limit(0), cells, sample, k, probes)


def cells_needed(spark: SparkSession, path: str, queries: DataFrame, k: int, vector: str = "embedding") -> DataFrame:
    """``cells, needed, items, items_needed``: what exact search reads, summed over the queries."""
    cells, sample = _cells(spark, path), sample_of(spark.read.parquet(f"{path}/sample"), "vector")
    named = _named(queries.withColumn("_query", F.lit(0)), "_query", vector, "query_id")
    pairs = named.mapInArrow(
        query_kernel(cells, sample, k, None), "cell int, query_id int, vector array<double>, floor double"
    )
    rows = F.get(F.array(*[F.lit(int(n)) for n in cells.rows]), F.col("cell"))
    asked = named.agg(F.count("*")).scalar()
    return pairs.agg(
        (asked * len(cells.rows)).alias("cells"),
        F.count("*").alias("needed"),
        (asked * int(cells.rows.sum())).alias("items"),
        F.sum(rows).alias("items_needed"),
    )


def recall_by_probes(
    spark: SparkSession,
    path: str,
    queries: DataFrame,
    k: int = 5,
    item_id: str = "id",
    query_id: str = "query_id",
    vector: str = "embedding",
) -> DataFrame:
    """``probes, recall``: share of the exact ``k`` best that this many cells would find.

    One exact search of the batch: each item found needs as many probes as its cell's place
    in the query's order of centres.
    """
    cells = _cells(spark, path)
    exact = search_index_batch(spark, path, queries, k, None, item_id, query_id, vector)

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                places = np.argsort(cells.nearest(matrix(batch.column("vector"))), axis=1) + 1
                ends = pa.array(np.arange(len(places) + 1, dtype=np.int32) * places.shape[1])
                places = pa.ListArray.from_arrays(ends, pa.array(places.astype(np.int32).ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("query_id"), places], ["asked", "places"])

    named = _named(queries, query_id, vector, "query_id")
    places = named.mapInArrow(order, f"asked {dict(named.dtypes)['query_id']}, places array<int>")
    needed = exact.join(places, exact["query_id"].eqNullSafe(places["asked"]))
    counts = needed.groupBy(F.get("places", F.col("cell")).alias("probes")).agg(F.count("*").alias("n"))
    # as few rows as cells
    so_far = F.sum("n").over(Window.orderBy("probes")) / F.sum("n").over(Window.partitionBy())
    return counts.select("probes", so_far.alias("recall"))


def search(
    items: DataFrame,
    query: DataFrame,
    k: int = 5,
    index: str | None = None,
    probes: int | None = None,
    item_id: str = "id",
    vector: str = "embedding",
) -> DataFrame:
    """Top-k through the index if there is a readable one, by exact search otherwise."""
    if index is not None:
        try:
            return search_index(items.sparkSession, index, query, k, probes, item_id, vector)
        except AnalysisException:
            log.warning("no index at %s, searching all items", index)
    return similar(items, query, k, item_id, vector)


def recall(found: DataFrame, exact: DataFrame, item_id: str = "id") -> DataFrame:
    """Share of the exact result that was found."""
    hits = exact.select(item_id).join(
        found.select(item_id, F.lit(1).alias("hit")), item_id, "left"
    )
    return hits.agg((F.count("hit") / F.count(F.lit(1))).alias("recall"))
