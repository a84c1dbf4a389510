"""Quality classifier: a regularised quadratic discriminant over document statistics.

Each class has a Gaussian with a shrunken covariance. The moments of the labelled rows are
summed by Spark; the score is the logistic of the difference of the two log-densities, from
Mahalanobis distances by Cholesky factors that are computed once and sent to the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlake.llm.common import LOWER, WHITE, binary, documents, lean, prepare, raw, span_hashes, stored, text_slices
from fieldlake.llm.registry import query

SLICE_BYTES = 4 << 20
#: Share of the pooled covariance in a class's, and of its mean variance on the diagonal.
TO_POOLED, TO_SPHERE = 0.2, 0.05
#: Rows of each class added to both sides of the prior.
PRIOR_ROWS = 1.0
#: Byte classes whose shares are statistics: lower, upper, digit, full stop and comma,
#: exclamation and question, bar, other ASCII signs, line break, other white space, beyond ASCII.
_CLASSES = 10
_CLASS = np.full(256, 6)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[[44, 46]], _CLASS[[33, 63]], _CLASS[124] = 3, 4, 5
_CLASS[WHITE], _CLASS[10], _CLASS[128:] = 8, 7, 9
STATISTICS = _CLASSES + 7


#: Shares that prose of any language has about, and how many bytes, words and lines of such
#: prose are added to a text, so that the shares of a few words are not taken for extremes.
_PROSE = (0.77, 0.02, 0.005, 0.02, 0.001, 0.0005, 0.0035, 0.01, 0.14, 0.03)
_BYTES, _WORDS, _LINES = 150.0, 25.0, 4.0
_WORD_BYTES = 5.0


def _shares(part: np.ndarray, whole: np.ndarray, usual: float, added: float) -> np.ndarray:
    """Shares on the scale where their spread does not depend on their size."""
    return np.arcsin(np.sqrt(np.clip((part + usual * added) / (whole + added), 0, 1)))


def _repeated(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    """How many spans of each text repeat an earlier one of the same text."""
    if not len(starts):
        return np.zeros(texts)
    key = span_hashes(data, starts, stops) ^ (text.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    _, first = np.unique(key, return_index=True)
    return np.bincount(text, minlength=texts) - np.bincount(text[first], minlength=texts)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of transformed statistics per packed text; an empty text has those of the usual prose."""
    texts = len(offsets) - 1
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(texts), sizes)
    counts = np.bincount(owner * _CLASSES + _CLASS[data], minlength=texts * _CLASSES).reshape(texts, _CLASSES)
    ink = ~WHITE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    opens = ink & (edge[:-1] | np.concatenate([[True], ~ink[:-1]])[: len(ink)])
    closes = ink & (edge[1:] | np.concatenate([~ink[1:], [True]])[: len(ink)])
    starts, stops = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    text = owner[starts] if len(starts) else np.zeros(0, np.int64)
    words = np.bincount(text, minlength=texts)
    lengths = stops - starts
    low = LOWER[data]
    breaks = (data == 10) | edge[1:]
    line_stops = np.flatnonzero(breaks) + (data[breaks] != 10)
    line_starts = np.concatenate([[0], np.flatnonzero(breaks)[:-1] + 1]) if len(line_stops) else line_stops
    full = line_stops > line_starts
    line_starts, line_stops = line_starts[full], line_stops[full]
    line_text = owner[line_starts] if len(line_starts) else np.zeros(0, np.int64)
    lines = np.bincount(line_text, minlength=texts)
    columns = [_shares(counts[:, k], sizes, _PROSE[k], _BYTES) for k in range(_CLASSES)]
    columns += [
        np.log1p(sizes),
        np.log((np.bincount(text, lengths, texts) + _WORD_BYTES * _WORDS) / (words + _WORDS)),
        _shares(np.bincount(text, lengths <= 3, texts), words, 0.4, _WORDS),
        _shares(np.bincount(text, lengths > 12, texts), words, 0.05, _WORDS),
        _shares(_repeated(low, starts, stops, text, texts), words, 0.2, _WORDS),
        _shares(_repeated(low, line_starts, line_stops, line_text, texts), lines, 0.02, _LINES),
        np.log((words + 20 * _LINES) / (lines + _LINES)),
    ]
    return np.stack(columns, axis=1)


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and its statistics (array<double>) for every row of ``docs`` (doc_id, text)."""
    prepare(docs.sparkSession)

    @lean
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, SLICE_BYTES):
            made = statistics(*raw(binary(batch.column("text"))))
            offsets = pa.array(np.arange(0, made.size + 1, STATISTICS, dtype=np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(made.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], ["doc_id", "statistics"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(kernel, f"doc_id {kind}, statistics array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), STATISTICS)


def class_moments(labelled: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Count, sums and sums of products by class of ``labelled`` (statistics, label).

    Each task sends one sum per class and place; a fixed number of sums reaches the driver.
    """
    width = 1 + STATISTICS + STATISTICS**2

    @lean
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, width))
        for batch in batches:
            values, labels = _matrix(batch.column("statistics")), batch.column("label").to_numpy()
            for label in (0, 1):
                rows = values[labels == label]
                sums[label] += np.concatenate([[len(rows)], rows.sum(axis=0), (rows.T @ rows).ravel()])
        label, place = np.divmod(np.arange(2 * width), width)
        yield pa.RecordBatch.from_arrays([pa.array(label), pa.array(place), pa.array(sums.ravel())], ["label", "place", "value"])

    added = (
        labelled.select("statistics", F.col("label").cast("int"))
        .mapInArrow(kernel, "label long, place long, value double")
        .groupBy("label", "place")
        .agg(F.sum("value").alias("value"))
    )
    found = np.zeros((2, width))
    for label, place, value in added.collect():
        found[label, place] = value
    return {
        label: (row[0], row[1 : 1 + STATISTICS], row[1 + STATISTICS :].reshape(STATISTICS, STATISTICS))
        for label, row in enumerate(found)
    }


@dataclass
class Discriminant:
    """Means, inverse Cholesky factors and log-weights of the classes, on a common scale."""

    scale: np.ndarray
    means: list[np.ndarray]
    factors: list[np.ndarray]
    offsets: list[float]

    def score(self, values: np.ndarray) -> np.ndarray:
        """Probability of class 1 of each row."""
        scaled = values / self.scale
        logs = [
            offset - 0.5 * (((scaled - mean) @ factor.T) ** 2).sum(axis=1)
            for mean, factor, offset in zip(self.means, self.factors, self.offsets)
        ]
        return 1 / (1 + np.exp(-np.clip(logs[1] - logs[0], -500, 500)))


def fit(moments: dict[int, tuple[float, np.ndarray, np.ndarray]]) -> Discriminant:
    """The discriminant of two classes' moments; a class without rows has the pooled shape."""
    total = sum(count for count, *_ in moments.values())
    mean = sum(sums for _, sums, _ in moments.values()) / max(total, 1)
    within = np.zeros((STATISTICS, STATISTICS))
    shapes = {}
    for label, (count, sums, products) in moments.items():
        own = sums / count if count else mean
        scatter = products - count * np.outer(own, own)
        shapes[label] = (count, own, scatter)
        within += scatter
    pooled = within / max(total, 1)
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
    pooled = pooled / np.outer(scale, scale)
    means, factors, offsets = [], [], []
    for label in (0, 1):
        count, own, scatter = shapes[label]
        covariance = scatter / count / np.outer(scale, scale) if count else pooled
        covariance = (1 - TO_POOLED) * covariance + TO_POOLED * pooled
        sphere = max(np.trace(covariance) / STATISTICS, 1e-3)
        covariance = (1 - TO_SPHERE) * covariance + TO_SPHERE * sphere * np.eye(STATISTICS)
        lower = np.linalg.cholesky(covariance)
        means.append(own / scale)
        factors.append(np.linalg.inv(lower))
        offsets.append(float(np.log((count + PRIOR_ROWS) / (total + 2 * PRIOR_ROWS)) - np.log(np.diag(lower)).sum()))
    return Discriminant(scale, means, factors, offsets)


def score(measured: DataFrame, model: Discriminant) -> DataFrame:
    """``measured`` (doc_id, statistics) with a score."""
    shipped = measured.sparkSession.sparkContext.broadcast(model)

    @lean
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = shipped.value.score(_matrix(batch.column("statistics")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made)], ["doc_id", "score"])

    kind = dict(measured.dtypes)["doc_id"]
    return measured.select("doc_id", "statistics").mapInArrow(kernel, f"doc_id {kind}, score double")


def remainder(doc_id: str, by: int) -> Column:
    """crc32 of an id as text, modulo ``by``; a null id has no remainder."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(by))


def fit_quality(measured: DataFrame, labels: DataFrame, held_out: Column) -> Discriminant:
    """Fit on the rows of ``measured`` that ``labels`` (doc_id, label) marks 0 or 1.

    Rows where ``held_out`` holds take no part. Every labelled row counts; a repeated id
    counts as often as it occurs. Null labels and ids are skipped.
    """
    known = labels.filter("label IN (0, 1)").filter(~F.coalesce(held_out, F.lit(False)))
    return fit(class_moments(measured.join(known, "doc_id")))


def score_quality(docs: DataFrame, labels: DataFrame, held_out: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, columns in ``keep`` and score of every row of ``docs`` (doc_id, text), fitted on ``labels``.

    Statistics are read from the whole text alone. A null text counts as empty; an empty text
    has a score. Without labelled rows every score is 0.5. Repeated rows are kept, an empty
    table gives no row, and other columns are not read.
    """
    if not keep:
        measured, _ = stored(document_statistics(docs), "quality-statistics")
        return score(measured, fit_quality(measured, labels, held_out))
    packed = docs.select(F.struct("doc_id", *keep).alias("doc_id"), "text")
    measured, _ = stored(document_statistics(packed), "quality-statistics")
    model = fit_quality(measured.select("doc_id.doc_id", "statistics"), labels, held_out)
    return score(measured, model).select("doc_id.*", "score")


@query()
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, learned from the labels whose id has another remainder than 1."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    held_out = remainder("doc_id", 3) == 1
    scored = score_quality(documents(spark, sf_dir).select("doc_id", "text"), labels, held_out)
    return scored.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
