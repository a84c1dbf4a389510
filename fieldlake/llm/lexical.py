"""Ranked lexical search by dense blocked matrix products.

Items are taken in measured blocks and tiles of them; a tile's terms are its columns. A task
counts the terms of its texts, and multiplies tiles of item weights with tiles of document
impacts in float64. Weights and impacts are integers, and a tile has so few columns that every
partial sum stays below 2**53, so the products are exact in any order of summation; the tiles
of one item are added as longs.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlake.llm.common import LOWER, binary, binary_array, documents, prepare, raw, text_slices
from fieldlake.llm.decontaminate import WORD
from fieldlake.llm.registry import query
from fieldlake.operators.rows import top_per_group

TOP = 50
#: Text of the items that one pass over the documents carries to the tasks.
BLOCK_BYTES = 8 << 20
SLICE_BYTES = 6 << 20
#: Items, documents and terms of a tile.
ITEMS, DOCS, TERMS = 256, 512, 4096
EXACT = 1 << 53
#: Fixed values of the score: scale of a weight and of an impact, and the parts of a length.
WEIGHT_SCALE, IMPACT_SCALE, TF_SCALE, LENGTH_SCALE = 1000, 1_000_000_000, 1000, 20
LENGTH_BASE, LENGTH_SHARE = 50, 50
#: Parts of an item's matches that are ranked apart before they meet.
PARTS = 32


def terms_of(texts: pa.BinaryArray) -> tuple[pa.BinaryArray, np.ndarray]:
    """(terms of all texts in order, number of terms of each text)."""
    data, offsets = raw(texts)
    ink = WORD[data]
    first = ink.copy()
    first[1:] &= ~ink[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    first[edges] = ink[edges]
    position = np.flatnonzero(first)
    kept = LOWER[data[ink]]
    before = np.cumsum(ink, dtype=np.int64)
    ends = np.append(before[position] - 1, len(kept))
    return binary_array(kept, ends), np.diff(np.searchsorted(position, offsets))


@dataclass
class Items:
    """Items of a block over the block's vocabulary."""

    names: pa.Array
    vocabulary: pa.Array
    owners: np.ndarray  # (item, term) pairs, each once, in order of the items
    terms: np.ndarray

    def tiles(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """(first item, items, the tile's terms in order, and its pairs over those terms)."""
        for start in range(0, len(self.names), ITEMS):
            low, high = np.searchsorted(self.owners, [start, start + ITEMS])
            terms, local = np.unique(self.terms[low:high], return_inverse=True)
            yield start, min(ITEMS, len(self.names) - start), terms, self.owners[low:high] - start, local


def items_of(rows: pa.Table) -> Items:
    """Items of a table (item_id, text): the rows of one id are one item, also of a null id."""
    names = rows.column("item_id").combine_chunks().dictionary_encode(null_encoding="encode")
    texts = binary(rows.column("text"))
    words, counts = terms_of(texts)
    encoded = words.dictionary_encode()
    owner = np.repeat(names.indices.to_numpy(), counts).astype(np.int64)
    size = max(1, len(encoded.dictionary))
    pairs = np.unique(owner * size + encoded.indices.to_numpy())
    return Items(names.dictionary, encoded.dictionary, pairs // size, pairs % size)


def _known(batch: pa.RecordBatch, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(documents, terms, occurrences) of the block's terms in a batch, and all terms of each text."""
    words, counts = terms_of(binary(batch.column("text")))
    place = pc.index_in(words, value_set=items.vocabulary)
    found = place.is_valid().to_numpy(zero_copy_only=False)
    size = max(1, len(items.vocabulary))
    keys = np.repeat(np.arange(len(counts)), counts)[found] * size + place.drop_null().to_numpy()
    keys, times = np.unique(keys, return_counts=True)
    return keys // size, keys % size, times, counts


def _statistics_kernel(shipped):
    """Per task: documents with a term (-1), all terms (-2), and documents of each item term."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shipped.value
        texts = total = 0
        holding = np.zeros(len(items.vocabulary), np.int64)
        for batch in text_slices(batches, SLICE_BYTES):
            _, terms, _, counts = _known(batch, items)
            texts, total = texts + int((counts > 0).sum()), total + int(counts.sum())
            holding += np.bincount(terms, minlength=len(holding))
        held = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append([-1, -2], held)), pa.array(np.append([texts, total], holding[held]))], ["term", "n"]
        )

    return kernel


@dataclass
class Statistics:
    """Documents with a term, all their terms, and a weight per term of the block."""

    texts: int
    total: int
    weights: np.ndarray


def statistics_of(docs: DataFrame, shipped) -> Statistics:
    """Counts over all documents; what returns has the size of the block's vocabulary."""
    counted = docs.mapInArrow(_statistics_kernel(shipped), "term long, n long")
    sums = counted.groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    found = dict(zip(sums.column("term").to_pylist(), sums.column("n").to_pylist()))
    texts, total = found.pop(-1, 0), found.pop(-2, 0)
    weights = np.zeros(len(shipped.value.vocabulary), np.int64)
    for term, df in found.items():
        weights[term] = math.floor(WEIGHT_SCALE * math.log((2 * texts + 2) / (2 * df + 1)))
    return Statistics(texts, total, weights)


def impacts(times: np.ndarray, lengths: np.ndarray, known: Statistics) -> np.ndarray:
    """Integer impact of a term that stands ``times`` in a document of ``lengths`` terms."""
    longest = int(lengths.max(initial=0))
    wide = lengths if LENGTH_SHARE * longest * known.texts < 1 << 63 else lengths.astype(object)
    norm = LENGTH_BASE + (LENGTH_SHARE * wide * known.texts) // max(1, known.total)
    return ((IMPACT_SCALE * times) // (TF_SCALE * times + LENGTH_SCALE * norm)).astype(np.int64)


class _Best:
    """The best documents of a tile's items so far, as parallel arrays."""

    def __init__(self, count: int, top: int):
        self.top = top
        self.item, self.score, self.missing, self.doc = (np.zeros(0, np.int64) for _ in range(4))
        self.bar = np.ones(count, np.int64)  # the least score that may still be among the best

    def add(self, scores: np.ndarray, missing: np.ndarray, docs: np.ndarray) -> None:
        """Take in a tile of scores (items, documents); ties with the bar are looked at, too."""
        item, column = np.nonzero(scores >= self.bar[:, None])
        if not len(item):
            return
        item = np.concatenate([self.item, item])
        score = np.concatenate([self.score, scores[item[len(self.item) :], column]])
        missing = np.concatenate([self.missing, missing[column]])
        doc = np.concatenate([self.doc, docs[column]])
        order = np.lexsort((doc, missing, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        order = order[place < self.top]
        item, place = item[place < self.top], place[place < self.top]
        self.item, self.score, self.missing, self.doc = item, score[order], missing[order], doc[order]
        full = place == self.top - 1
        self.bar[item[full]] = self.score[full]


def _score_kernel(shipped, known: Statistics, top: int):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shipped.value
        size = len(items.vocabulary)
        heaviest = IMPACT_SCALE // TF_SCALE * max(1, int(known.weights.max(initial=0)))
        width = max(1, min(TERMS, (EXACT - 1) // heaviest))
        best = {start: _Best(count, top) for start, count, *_ in items.tiles()}
        for batch in text_slices(batches, SLICE_BYTES):
            row, term, times, counts = _known(batch, items)
            impact = impacts(times, counts[row], known)
            ids = batch.column("doc_id")
            missing = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
            docs = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
            for start, count, terms, owner, local in items.tiles():
                column_of = np.full(size, -1, np.int64)
                column_of[terms] = np.arange(len(terms))
                column = column_of[term]
                scores = np.zeros((count, len(docs)), np.int64)
                for left in range(0, len(terms), width):
                    wide = min(width, len(terms) - left)
                    mine = (local >= left) & (local < left + wide)
                    weight = np.zeros((count, wide))
                    weight[owner[mine], local[mine] - left] = known.weights[terms[local[mine]]]
                    inside = np.flatnonzero((column >= left) & (column < left + wide))
                    cuts = np.searchsorted(row[inside], np.arange(0, len(docs) + DOCS, DOCS))
                    for first, low, high in zip(range(0, len(docs), DOCS), cuts, cuts[1:]):
                        some = inside[low:high]
                        tile = np.zeros((wide, min(DOCS, len(docs) - first)))
                        tile[column[some] - left, row[some] - first] = impact[some]
                        scores[:, first : first + DOCS] += (weight @ tile).astype(np.int64)
                for first in range(0, len(docs), DOCS):
                    tile = slice(first, first + DOCS)
                    best[start].add(scores[:, tile], missing[tile], docs[tile])
        for start, found in best.items():
            if len(found.item):
                docs = pa.array(found.doc, pa.int64(), mask=found.missing.astype(bool))
                yield pa.RecordBatch.from_arrays(
                    [items.names.take(pa.array(found.item + start)), docs, pa.array(found.score)], ["item_id", "doc_id", "score"]
                )

    return kernel


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of every item with a score above 0.

    ``docs`` has integer doc_id and text, ``items`` item_id and text; other columns are not
    read. Terms are runs of ASCII letters and digits and of all characters beyond ASCII of the
    whole text, with A-Z lower-cased. Null and empty texts have none: such documents count
    nowhere, such items get no row. Equal scores are ordered by doc_id, a null one last.
    Repeated rows of a document are ranked each; the rows of one item_id (or of the null one)
    are one item. An empty table on either side gives no row.

    Documents are read twice per block of items and not shuffled; per task and item ``top``
    rows are, first dealt in parts.
    """
    spark = prepare(docs.sparkSession)
    named = docs.select(F.col("doc_id").cast("long"), "text")
    wanted = items.select("item_id", "text").filter(F.col("text").isNotNull())
    size = wanted.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + int(size) // BLOCK_BYTES
    schema = f"item_id {dict(items.dtypes)['item_id']}, doc_id long, score long"
    found = []
    for block in range(blocks):
        part = wanted.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).toArrow()
        shipped = spark.sparkContext.broadcast(items_of(part))
        if len(shipped.value.vocabulary):
            known = statistics_of(named, shipped)
            found.append(named.mapInArrow(_score_kernel(shipped, known, top), schema))
    if not found:
        return spark.createDataFrame([], schema).select("item_id", F.lit(0).alias("rank"), "doc_id", "score")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    partial = functools.reduce(DataFrame.union, found).withColumn("_part", F.spark_partition_id() % PARTS)
    partial = top_per_group(partial, ["item_id", "_part"], order, top).drop("rank", "_part")
    return top_per_group(partial, ["item_id"], order, top).select("item_id", "rank", "doc_id", "score")


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    f"""WITH texts AS (SELECT doc_id, {_WORDS} AS words FROM documents WHERE text IS NOT NULL),
    whole AS (SELECT count(*) AS texts, sum(len(words))::BIGINT AS total FROM texts WHERE len(words) > 0),
    placed AS (SELECT doc_id, len(words) AS n, unnest(words) AS term FROM texts),
    counted AS (SELECT doc_id, n, term, count(*) AS tf FROM placed GROUP BY ALL),
    wanted AS (SELECT DISTINCT item_id, unnest({_WORDS}) AS term FROM benchmark WHERE text IS NOT NULL),
    weights AS (SELECT term, floor(1000 * ln((2 * any_value(texts) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
                FROM counted, whole WHERE term IN (SELECT term FROM wanted) GROUP BY term),
    impacts AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * texts) // total))) AS part
                FROM counted JOIN weights USING (term), whole),
    scores AS (SELECT item_id, doc_id, sum(part)::BIGINT AS score FROM wanted JOIN impacts USING (term) GROUP BY ALL),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place
               FROM scores WHERE score > 0)
    SELECT item_id, place::INTEGER AS "rank", doc_id, score FROM ranked WHERE place <= {TOP}"""
)
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents for every benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return ranked_search(documents(spark, sf_dir).select("doc_id", "text"), benchmark)
