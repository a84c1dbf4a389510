"""Embedding near-dedup by a pivot-permutation index.

A vector is described by its nearest reference points (pivots) in order. It stands in the
inverted lists of the first ``POSTED`` of them; vectors that meet in a list and share
``SHARED`` of their ``DESCRIBED`` pivots are verified by their cosine. A list is met in
pairs of chunks of bounded size, and a pair is counted in the first list that both share, so
links are added up without listing pairs.

Pivots are mutually unlike vectors of a bounded sample, one pivot per ``sqrt(n)`` vectors
between ``LEAST_PIVOTS`` and ``MOST_PIVOTS``; every vector is indexed. ``recall`` measures
the share of true links found, by brute force for a set of query vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlake.llm.common import drop, prepare, stored
from fieldlake.llm.components import components
from fieldlake.llm.registry import query

DESCRIBED, POSTED, SHARED = 8, 5, 2
LEAST_PIVOTS, MOST_PIVOTS, SAMPLED_PER_PIVOT = 64, 2048, 8
#: Pivots are at most this alike, so that a crowd of near copies gives one of them.
PIVOT_COSINE = 0.8
CHUNK = 1024
#: Class keys: the least vec_id, or from here on a number of its own where no row has an id.
NODE, NO_ID = "decimal(20,0)", Decimal(2**63)


def usable(embedding: Column) -> Column:
    """Whether a vector is there, has finite components only, and is not zero."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return embedding.isNotNull() & ~bad & F.exists(embedding, lambda x: x != 0)


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of equal length, scaled to length one, in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy().astype(np.float64).reshape(len(column), -1)
    values = values / np.abs(values).max(axis=1, keepdims=True)  # squares of large values stay finite
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def choose_pivots(sample: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` vectors of the sample, in order, that are unlike those before them."""
    chosen = np.zeros((0, sample.shape[1]))
    for vector in sample:
        if len(chosen) == most:
            break
        if not len(chosen) or (chosen @ vector).max() < PIVOT_COSINE:
            chosen = np.vstack([chosen, vector])
    return chosen


def _describe(shipped):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            near = _matrix(batch.column("embedding")) @ shipped.value.T
            width = min(DESCRIBED, near.shape[1])
            order = np.argsort(-near, axis=1, kind="stable")[:, :width].astype(np.int32)
            offsets = pa.array(np.arange(0, order.size + 1, width, dtype=np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(order.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "pivots"])

    return kernel


def _first_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least pivot in the posted parts of both of each pair."""
    least = np.full(len(a), np.iinfo(np.int32).max, np.int32)
    for column in a.T:
        least = np.where((column[:, None] == b).any(axis=1), np.minimum(least, column), least)
    return least


def _verify(threshold: float):
    """Links by node, and few of them that connect all, of two chunks of one list."""

    def kernel(table: pa.Table) -> pa.Table:
        pivot = table.column("pivot")[0].as_py()
        same = table.column("a")[0].as_py() == table.column("b")[0].as_py()
        sides = table.column("side").to_numpy()
        values, nodes = _matrix(table.column("embedding")), table.column("node").combine_chunks()
        copies = table.column("copies").to_numpy()
        order = table.column("pivots").combine_chunks().flatten().to_numpy().reshape(len(nodes), -1)
        left = np.flatnonzero(sides == 0)
        right = left if same else np.flatnonzero(sides == 1)
        links, group = np.zeros(len(nodes), np.int64), np.arange(len(nodes))
        local = np.unique(order, return_inverse=True)[1].reshape(order.shape)
        marks = np.zeros((len(nodes), local.max(initial=0) + 1), np.float32)
        np.put_along_axis(marks, local, 1, axis=1)
        if len(left) and len(right):
            met = marks[left] @ marks[right].T >= min(SHARED, order.shape[1])
            met &= values[left] @ values[right].T >= threshold
            if same:
                met &= np.arange(len(left))[:, None] < np.arange(len(right))[None, :]
            i, j = np.nonzero(met)
            mine = _first_shared(order[left[i], :POSTED], order[right[j], :POSTED]) == pivot
            i, j = left[i[mine]], right[j[mine]]
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            while True:  # each takes the least group among its links, until none changes
                least = group.copy()
                np.minimum.at(least, i, group[j])
                np.minimum.at(least, j, group[i])
                least = least[least]
                if (least == group).all():
                    break
                group = least
        found = np.flatnonzero(links)
        return pa.table({"node": nodes.take(found), "links": links[found], "other": nodes.take(group[found])})

    return kernel


_LINKS = f"node {NODE}, links long, other {NODE}"


def near_vectors(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors`` (vec_id long, embedding).

    Two vectors link at a cosine of ``threshold`` or more; none below it is linked. Vectors
    that are null, zero or have null or non-finite components link with nothing, nor do
    vectors of different lengths. Equal vectors are compared once and all count. A row with a
    null vec_id counts as a link of equal and near vectors and connects them; its component is
    the least id reachable, or null. An empty table gives no row;
    other columns are not read.
    """
    spark = prepare(vectors.sparkSession)
    rows = vectors.select("vec_id", "embedding")
    good = rows.filter(usable(F.col("embedding")))
    classes = good.groupBy("embedding").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
    # numbered as they are written, so a class without an id keeps its number
    unnamed = F.monotonically_increasing_id().cast(NODE) + F.lit(NO_ID).cast(NODE)
    classes = classes.withColumn("node", F.coalesce(F.col("node").cast(NODE), unnamed.cast(NODE)))
    classes, at = stored(classes, "vector-classes")
    places = [at]
    links = spark.createDataFrame([], _LINKS)
    lengths = [row.width for row in classes.groupBy(F.size("embedding").alias("width")).count().collect()]
    for width in lengths:
        found, path = stored(_links_of(classes.filter(F.size("embedding") == width), threshold), "vector-links")
        links = links.union(found)
        places.append(path)
    linked = links.groupBy("node").agg(F.sum("links").alias("links"))
    members = components(links.select(F.col("node").alias("u"), F.col("other").alias("v")))
    least = F.coalesce("component", "node")
    judged, _ = stored(
        classes.join(linked, "node", "left")
        .join(members, "node", "left")
        .select(
            "embedding",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.when(least < NO_ID, least.cast("long")).alias("component_id"),
        ),
        "vector-judged",
    )
    drop(spark, *places)
    result = good.join(judged, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.filter(~F.coalesce(usable(F.col("embedding")), F.lit(False))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return result.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _links_of(classes: DataFrame, threshold: float) -> DataFrame:
    """(node, links, other) sums of links by class for distinct vectors of one length."""
    spark = classes.sparkSession
    count = classes.count()
    most = int(min(MOST_PIVOTS, max(LEAST_PIVOTS, count**0.5)))
    sample = classes.orderBy(F.xxhash64("node"), "node").limit(most * SAMPLED_PER_PIVOT).select("embedding").toArrow()
    shipped = spark.sparkContext.broadcast(choose_pivots(_matrix(sample.column("embedding")), most))
    described, path = stored(
        classes.mapInArrow(_describe(shipped), f"embedding array<float>, node {NODE}, copies long, pivots array<int>"),
        "vector-pivots",
    )
    posted = described.select("*", F.explode(F.slice("pivots", 1, POSTED)).alias("pivot"))
    chunks = posted.groupBy("pivot").agg(F.expr(f"cast(ceil(count(*) / {CHUNK}) as int)").alias("chunks"))
    placed = posted.join(chunks, "pivot").withColumn("own", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    pairs = placed.withColumn("against", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "pivot",
        F.least("own", "against").alias("a"),
        F.greatest("own", "against").alias("b"),
        (F.col("own") > F.col("against")).cast("int").alias("side"),
        "node",
        "copies",
        "embedding",
        "pivots",
    )
    return pairs.groupBy("pivot", "a", "b").applyInArrow(_verify(threshold), _LINKS)


def _true_links(vectors: DataFrame, asked: np.ndarray, threshold: float) -> int:
    """Links of the asked vectors, which are among ``vectors``, by brute force."""
    shipped = vectors.sparkSession.sparkContext.broadcast(asked)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = _matrix(batch.column("embedding")) @ shipped.value.T >= threshold
                yield pa.RecordBatch.from_arrays([pa.array([int(near.sum())])], ["links"])

    return (vectors.mapInArrow(kernel, "links long").agg(F.sum("links")).first()[0] or 0) - len(asked)


def recall(vectors: DataFrame, found: DataFrame, threshold: float = 0.9, every: int = 50) -> float:
    """Share of the links of the vectors with an id divisible by ``every`` that ``found`` counts.

    Brute force: the query vectors, in blocks, against all vectors.
    """
    prepare(vectors.sparkSession)
    good = vectors.select("vec_id", "embedding").filter(usable(F.col("embedding")))
    queries = good.filter(F.pmod("vec_id", F.lit(every)) == 0)
    true = 0
    for width, count in queries.groupBy(F.size("embedding")).count().collect():
        alike, blocks = F.size("embedding") == width, 1 + count // 2048
        for block in range(blocks):
            asked = queries.filter(alike).filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).toArrow()
            if asked.num_rows:
                true += _true_links(good.filter(alike), _matrix(asked.column("embedding")), threshold)
    counted = found.join(queries.select("vec_id"), "vec_id", "semi").agg(F.sum("n_links")).first()[0] or 0
    return counted / true if true else 1.0


@query()
def op8_pivot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings against each other at a cosine of 0.9."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return near_vectors(vectors, 0.9)
