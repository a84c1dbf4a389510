"""Vectors dealt to cells around centres, and batches of queries joined to items by cell.

No item of a cell scores above ``q·c + |q|·r`` for a query q, where c is the cell's centre and r
the largest distance of its items from it. The k-th best score among a sample of the items is
a floor under the final k-th, so a query need not go to a cell whose bound lies below its floor.
The result does not depend on the centres or the sample; only the work does.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlake.operators.rows import top_n, top_per_group

#: Items whose vectors are collected: centres are fitted to them, floors are taken from them.
SAMPLE = 4096
#: Items of a cell that one task holds; larger cells are split.
CELL_ROWS = 32_768
LEAST_ROWS = 512
MOST_CELLS = 512
SCORES_AT_ONCE = 1_000_000
#: Queries that meet a cell's items together.
QUERIES_AT_ONCE = 2048
#: Bytes of vectors in a batch of queries that go to their cells.
SENT_BYTES = 8 << 20
#: Room for the rounding of bounds and scores, as a share of the largest score possible.
SLACK = 1e-9


def usable(vector: Column) -> Column:
    """Whether a vector and all its entries are there and finite."""
    return vector.isNotNull() & F.forall(vector, lambda c: c.isNotNull() & (F.abs(c) < float("inf")))


def matrix(vectors: pa.Array) -> np.ndarray:
    """Rows of a list column of one length, in double precision."""
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(vectors), -1)


@dataclass
class Cells:
    """Centres with the radius and the number of items of each cell; empty cells have none."""

    centres: np.ndarray
    radius: np.ndarray
    rows: np.ndarray

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Per query and cell, a score that no item of the cell exceeds."""
        size = np.linalg.norm(queries, axis=1)[:, None]
        reach = np.linalg.norm(self.centres, axis=1) + self.radius
        bound = queries @ self.centres.T + size * self.radius + SLACK * (1 + size * reach)
        return np.where(self.rows > 0, bound, -np.inf)

    def nearest(self, queries: np.ndarray) -> np.ndarray:
        """Per query, the cells in falling order of their centres' scores."""
        scores = np.where(self.rows > 0, np.round(queries @ self.centres.T, 12), -np.inf)
        return np.argsort(-scores, axis=1, kind="stable")


def sample_of(items: DataFrame, vector: str, rows: int = SAMPLE) -> np.ndarray:
    """Vectors of at most ``rows`` items with the least hashes: always the same ones."""
    some = top_n(items.select(vector), [F.xxhash64(vector)], rows).toArrow().column(vector)
    if not len(some):
        return np.zeros((0, 0))
    whole = some.combine_chunks()
    return matrix(pa.concat_arrays(whole.chunks) if isinstance(whole, pa.ChunkedArray) else whole)


def _distances(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (centres**2).sum(axis=1) - 2 * (vectors @ centres.T)


def centres_of(sample: np.ndarray, cells: int, rounds: int = 8) -> np.ndarray:
    """Centres of a bounded sample: means of the nearest vectors, some rounds over."""
    distinct = np.unique(sample, axis=0)
    start = np.random.default_rng(42).permutation(len(distinct))[:cells]
    centres = distinct[np.sort(start)]
    for _ in range(rounds):
        nearest = _distances(sample, centres).argmin(axis=1)
        counts = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def _assign_kernel(centres: np.ndarray, vector: str):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, SCORES_AT_ONCE // max(1, len(centres)))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                some = batch.slice(start, step)
                values = matrix(some.column(vector))
                nearest = _distances(values, centres).argmin(axis=1)
                away = np.linalg.norm(values - centres[nearest], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nearest.astype(np.int32)), pa.array(away), *some.columns], ["cell", "_distance", *some.schema.names]
                )

    return kernel


def assigned(items: DataFrame, vector: str, centres: np.ndarray) -> DataFrame:
    """Items with the ``cell`` of the nearest centre and the ``_distance`` to it."""
    kinds = ", ".join(f"`{name}` {kind}" for name, kind in items.dtypes)
    return items.mapInArrow(_assign_kernel(centres, vector), f"cell int, _distance double, {kinds}")


def cell_sizes(items: DataFrame) -> DataFrame:
    """``cell, radius, rows`` of assigned items."""
    return items.groupBy("cell").agg(F.max("_distance").alias("radius"), F.count("*").alias("rows"))


def cells_of(centres: np.ndarray, sizes: DataFrame) -> Cells:
    """Centres with what ``sizes`` (as few rows as cells) says about them."""
    radius, rows = np.zeros(len(centres)), np.zeros(len(centres), np.int64)
    for size in sizes.filter("cell >= 0").collect():
        radius[size["cell"]], rows[size["cell"]] = size["radius"], size["rows"]
    return Cells(centres, radius, rows)


def first_k(
    queries: np.ndarray, items: np.ndarray, scores: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best (query, item, score) triples per query; equal scores in the order of items."""
    order = np.lexsort((items, -scores, queries))
    queries, items, scores = queries[order], items[order], scores[order]
    position = np.arange(len(queries)) - np.searchsorted(queries, queries, side="left")
    keep = position < k
    return queries[keep], items[keep], scores[keep]


def rank_block(
    queries: np.ndarray, items: np.ndarray, vectors: np.ndarray, k: int, floor: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best items of a block for every query, none below the query's floor.

    Scores are rounded to 12 decimals: copies of a vector then tie whatever their place in the
    block, and the item's number decides.
    """
    none = np.zeros(0, np.int64)
    best = (none, none, np.zeros(0))
    step = max(256, SCORES_AT_ONCE // max(1, len(queries)))
    for start in range(0, len(items), step):
        some = items[start : start + step]
        scores = np.round(queries @ vectors[start : start + step].T, 12)
        bar = floor
        if len(some) > k:
            bar = np.maximum(bar, np.partition(scores, len(some) - k, axis=1)[:, len(some) - k])
        query, item = np.nonzero(scores >= bar[:, None])
        found = (query, some[item], scores[query, item])
        best = first_k(*[np.concatenate(pair) for pair in zip(best, found)], k)
    return best


def _floors(queries: np.ndarray, sample: np.ndarray, k: int) -> np.ndarray:
    """Per query, a score that its k-th best item reaches: that of the k-th best sampled one."""
    floor = np.full(len(queries), -np.inf)
    if k <= len(sample):
        step = max(1, SCORES_AT_ONCE // len(sample))
        for start in range(0, len(queries), step):
            some = queries[start : start + step]
            scores = np.round(some @ sample.T, 12)
            room = SLACK * (1 + np.linalg.norm(some, axis=1) * np.linalg.norm(sample, axis=1).max(initial=0))
            floor[start : start + step] = np.partition(scores, len(sample) - k, axis=1)[:, len(sample) - k] - room
    return floor


def query_kernel(cells: Cells, sample: np.ndarray, k: int, probes: int | None):
    """Queries with their floor, once for each cell they have to go to."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, SCORES_AT_ONCE // max(1, len(cells.rows)))
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                queries = matrix(batch.column("vector"))
                if probes is None:
                    floor = _floors(queries, sample, k)
                    query, cell = np.nonzero((cells.bounds(queries) >= floor[:, None]) & (cells.rows > 0))
                else:
                    floor = np.full(len(queries), -np.inf)
                    near = cells.nearest(queries)[:, :probes]
                    query, cell = np.repeat(np.arange(len(queries)), near.shape[1]), near.ravel()
                # a query goes to most cells where there are no clusters, and takes its vector along
                most = max(1, SENT_BYTES // (8 * max(1, queries.shape[1])))
                for first in range(0, len(query), most):
                    some = query[first : first + most]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(cell[first : first + most].astype(np.int32)),
                            batch.column("query_id").take(pa.array(some)),
                            batch.column("vector").take(pa.array(some)),
                            pa.array(floor[some]),
                        ],
                        ["cell", "query_id", "vector", "floor"],
                    )

    return kernel


class _Group:
    """Items of one (cell, salt, part), met by the queries of the same in the order of the rows."""

    def __init__(self) -> None:
        self.key: tuple | None = None

    def start(self, key: tuple) -> None:
        if key != self.key:
            self.key, self.parts, self.ids, self.vectors = key, [], None, None

    def add(self, rows: pa.RecordBatch) -> None:
        self.parts.append(rows)

    def match(self, rows: pa.RecordBatch, k: int) -> pa.RecordBatch | None:
        if self.parts:
            ids = pa.concat_arrays([part.column("item_id") for part in self.parts])
            order = pc.array_sort_indices(ids, null_placement="at_start")
            self.ids = ids.take(order)
            self.vectors = matrix(pa.concat_arrays([part.column("vector") for part in self.parts]).take(order))
            self.parts = []  # the batches are not held beside the matrix
        if self.ids is None:
            return None
        queries, floor = matrix(rows.column("vector")), rows.column("floor").to_numpy()
        query, item, score = rank_block(queries, np.arange(len(self.ids)), self.vectors, k, floor)
        if not len(query):
            return None
        cell = pa.array(np.full(len(query), self.key[0], np.int32))
        return pa.RecordBatch.from_arrays(
            [rows.column("query_id").take(pa.array(query)), self.ids.take(pa.array(item)), pa.array(score), cell],
            ["query_id", "item_id", "score", "cell"],
        )


def _match_kernel(k: int):
    """Over rows in order of cell, salt, part, items before queries."""
    keys = ("cell", "salt", "part", "asks")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = _Group()
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64) for name in keys], axis=1)
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            for start, stop in zip([0, *cuts], [*cuts, batch.num_rows]):
                group.start(tuple(key[start, :3]))
                if not key[start, 3]:
                    group.add(batch.slice(start, stop - start))
                    continue
                for first in range(start, stop, QUERIES_AT_ONCE):
                    found = group.match(batch.slice(first, min(QUERIES_AT_ONCE, stop - first)), k)
                    if found is not None:
                        yield found

    return kernel


def _counted(counts: np.ndarray) -> Column:
    """The number of parts of the row's cell."""
    return F.get(F.array(*[F.lit(int(n)) for n in counts]), F.col("cell"))


def join_by_cell(
    items: DataFrame, queries: DataFrame, cells: Cells, sample: np.ndarray, k: int, probes: int | None = None
) -> DataFrame:
    """``query_id, item_id, score, cell, rank``: the ``k`` best items for every query.

    ``items`` is cell, item_id, vector; ``queries`` is query_id, vector. Items are shuffled
    once, by cell and salt, and held by the task that the queries of that cell stream past. A
    cell above ``CELL_ROWS`` items is split by salt; where there are fewer groups than cores,
    each is copied for parts of the queries. With ``probes``, queries go to that many cells of
    highest centre score instead of all they need.
    """
    spark = items.sparkSession
    salts = np.maximum(1, -(-cells.rows // CELL_ROWS))
    groups = max(1, int(salts[cells.rows > 0].sum()))
    cores = spark.sparkContext.defaultParallelism
    parts = max(1, cores // groups)
    kind = {**dict(items.dtypes), **dict(queries.dtypes)}
    ids = f"query_id {kind['query_id']}, item_id {kind['item_id']}"
    missing = lambda name: F.lit(None).cast(kind[name]).alias(name)
    asked = queries.mapInArrow(
        query_kernel(cells, sample, k, probes), f"cell int, query_id {kind['query_id']}, vector {kind['vector']}, floor double"
    )
    asked = asked.select(
        "cell",
        F.explode(F.sequence(F.lit(0), _counted(salts) - 1)).alias("salt"),
        F.pmod(F.xxhash64("query_id", "vector"), F.lit(parts)).cast("int").alias("part"),
        F.lit(1).alias("asks"),
        "query_id",
        missing("item_id"),
        "vector",
        "floor",
    )
    held = items.select(
        "cell",
        F.pmod(F.xxhash64("item_id", "vector"), _counted(salts)).cast("int").alias("salt"),
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
        F.lit(0).alias("asks"),
        missing("query_id"),
        "item_id",
        "vector",
        F.lit(None).cast("double").alias("floor"),
    )
    key = ["cell", "salt", "part"]
    dealt = held.union(asked).repartition(2 * groups * parts, *key).sortWithinPartitions(*key, "asks")
    partial = dealt.mapInArrow(_match_kernel(k), f"{ids}, score double, cell int")
    return top_per_group(partial, ["query_id"], [F.desc("score"), F.asc("item_id")], k)


def cells_for(rows: int, cores: int) -> int:
    """Cells for a join of a batch: as many as keep a cell within a task's share of the rows."""
    share = min(CELL_ROWS, max(LEAST_ROWS, math.ceil(rows / max(1, cores))))
    return max(1, min(MOST_CELLS, math.ceil(rows / share)))
