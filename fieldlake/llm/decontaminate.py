"""Benchmark decontamination by an FM-index per shard of the training texts.

A shard is a slice of a task's texts. Its symbols are the words that occur in the benchmark;
every other word, and every end of a text, is a separator, because no window holds it. The
windows are searched backwards through wavelet-matrix ranks, occurrences are located from
sampled suffix positions, and the removal spans are merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlake.llm.common import LOWER, binary, documents, lean, prepare, raw, span_hashes, text_slices
from fieldlake.llm.registry import query

SLICE_BYTES = 6 << 20
#: Text of the benchmark that one pass over the documents carries to the tasks.
BLOCK_BYTES = 8 << 20
SAMPLE = 8
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[65:91] = WORD[97:123] = WORD[128:] = True


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, stops, hashes, first word of each text) of packed texts' words."""
    ink = WORD[data]
    first = ink.copy()
    first[1:] &= ~ink[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    first[edges] = ink[edges]
    last = np.zeros(len(data) + 1, bool)
    last[1:] = ink
    last[1:-1] &= ~ink[1:] | first[1:]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last)
    hashes = span_hashes(LOWER[data], starts, stops)
    return starts, stops, hashes, np.searchsorted(starts, offsets)


@dataclass
class Windows:
    """Distinct windows of a block of items, over the block's vocabulary."""

    hashes: np.ndarray  # sorted word hashes; a word's symbol is its place plus one
    spelled: np.ndarray  # the words' bytes, one after another, in that order
    spelled_at: np.ndarray
    symbols: np.ndarray  # one row per window, zero beyond its length
    lengths: np.ndarray
    items: list[np.ndarray]  # per window, the numbers of its items
    names: list[str | None]


def windows_of(items: list[tuple[object, str | None]], size: int) -> Windows:
    """Windows of ``size`` words; an item of fewer words is one window, of none is skipped."""
    texts = binary(pa.array([text for _, text in items], pa.string()))
    data, offsets = raw(texts)
    starts, stops, hashes, first = words_of(data, offsets)
    vocabulary, at, symbol = np.unique(hashes, return_index=True, return_inverse=True)
    low = LOWER[data]
    spelled = [low[starts[i] : stops[i]] for i in at]
    found: dict[tuple[int, ...], set[int]] = {}
    for item in range(len(items)):
        words = (symbol[first[item] : first[item + 1]] + 1).tolist()
        for begin in range(max(1, len(words) - size + 1) if words else 0):
            found.setdefault(tuple(words[begin : begin + size]), set()).add(item)
    symbols = np.zeros((len(found), size), np.int64)
    for row, window in enumerate(found):
        symbols[row, : len(window)] = window
    return Windows(
        vocabulary,
        np.concatenate(spelled) if spelled else np.zeros(0, np.uint8),
        np.concatenate([[0], np.cumsum([len(word) for word in spelled])]).astype(np.int64),
        symbols,
        (symbols > 0).sum(axis=1),
        [np.array(sorted(owners)) for owners in found.values()],
        [None if name is None else str(name) for name, _ in items],
    )


def suffix_order(symbols: np.ndarray, separators: np.ndarray) -> np.ndarray:
    """Suffix array by doubling; separators are unlike each other, in order of place."""
    n = len(symbols)
    count = int(separators.sum())
    rank = symbols + count
    rank[separators] = np.arange(count)
    _, rank = np.unique(rank, return_inverse=True)
    width = 1
    while True:
        behind = np.zeros(n, np.int64)
        behind[: n - width] = rank[width:] + 1
        key = rank * (n + 1) + behind
        order = np.argsort(key, kind="stable")
        fresh = np.ones(n, np.int64)
        fresh[1:] = key[order][1:] != key[order][:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh) - 1
        if rank[order[-1]] == n - 1:
            return order
        width *= 2


class FMIndex:
    """Burrows-Wheeler transform of a shard's symbols with ranks and sampled positions."""

    def __init__(self, symbols: np.ndarray):
        separators = symbols == 0
        order = suffix_order(symbols, separators)
        self.bwt = symbols[order - 1]
        self.levels = max(1, int(symbols.max(initial=0)).bit_length())
        counts = np.bincount(symbols, minlength=(1 << self.levels) + 1)
        self.before = np.concatenate([[0], np.cumsum(counts)])
        self.ones: list[np.ndarray] = []
        column = self.bwt
        for level in range(self.levels - 1, -1, -1):
            bits = (column >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bits)]).astype(np.int32))
            column = np.concatenate([column[bits == 0], column[bits == 1]])
        # every eighth place, and the first of each run, whose step back meets a separator
        kept = (np.arange(len(symbols)) % SAMPLE == 0) | np.concatenate([[True], separators[:-1]])
        self.marked = kept[order]
        self.sampled = order[self.marked]
        self.sample_rank = np.cumsum(self.marked) - 1

    def rank(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """How often each symbol stands in the transform before its row."""
        left, right = np.zeros_like(row), row
        for depth, ones in enumerate(self.ones):
            zeros = len(self.bwt) - int(ones[-1])
            bit = (symbol >> (self.levels - 1 - depth)) & 1
            left_ones, right_ones = ones[left], ones[right]
            left = np.where(bit == 1, zeros + left_ones, left - left_ones)
            right = np.where(bit == 1, zeros + right_ones, right - right_ones)
        return right - left

    def search(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last (exclusive) row of each pattern, from its last symbol to its first."""
        low, high = np.zeros(len(symbols), np.int64), np.full(len(symbols), len(self.bwt), np.int64)
        # a symbol of more bits than the shard's own has no place in the ranks: it stands nowhere
        high[symbols.max(axis=1, initial=0) >> self.levels > 0] = 0
        live = np.flatnonzero((lengths > 0) & (high > 0))
        for back in range(1, symbols.shape[1] + 1):
            live = live[(low[live] < high[live]) & (lengths[live] >= back)] if back > 1 else live
            if not len(live):
                break
            symbol = symbols[live, lengths[live] - back]
            low[live] = self.before[symbol] + self.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places of the rows: steps back to a sampled row, plus its place."""
        place, steps = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        live, rows = np.arange(len(rows)), rows.copy()
        while len(live):
            done = self.marked[rows[live]]
            ended = live[done]
            place[ended] = self.sampled[self.sample_rank[rows[ended]]] + steps[ended]
            live = live[~done]
            symbol = self.bwt[rows[live]]
            rows[live] = self.before[symbol] + self.rank(symbol, rows[live])
            steps[live] += 1
        return place


def find_windows(data: np.ndarray, offsets: np.ndarray, known: Windows):
    """(words per text, starts, stops, first, occurrence's first word, its window)."""
    starts, stops, hashes, first = words_of(data, offsets)
    none = np.zeros(0, np.int64)
    shortest = int(known.lengths.min(initial=1 << 30))
    if not len(hashes) or not len(known.lengths):
        return starts, stops, first, none, none
    place = np.searchsorted(known.hashes, hashes)
    place[place == len(known.hashes)] = 0
    symbol = np.where(known.hashes[place] == hashes, place + 1, 0)
    # runs of known words within a text; shorter ones than any window cannot hold one
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    fresh = np.ones(len(symbol), bool)
    fresh[1:] = (symbol[1:] == 0) | (symbol[:-1] == 0) | (text[1:] != text[:-1])
    run = np.cumsum(fresh) - 1
    kept = (symbol > 0) & (np.bincount(run)[run] >= shortest)
    words = np.flatnonzero(kept)
    if not len(words):
        return starts, stops, first, none, none
    # one separator before each run, and one at the end
    slot = np.arange(len(words)) + np.cumsum(fresh[words])
    symbols = np.zeros(slot[-1] + 2, np.int64)
    symbols[slot] = symbol[words]
    index = FMIndex(symbols)
    low, high = index.search(known.symbols, known.lengths)
    hits = np.flatnonzero(high > low)
    counts = high[hits] - low[hits]
    window = np.repeat(hits, counts)
    rows = np.repeat(low[hits] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
    word_at = np.zeros(len(symbols), np.int64)
    word_at[slot] = words
    begin = word_at[index.locate(rows)]
    same = spelled_alike(data, starts, stops, symbol, begin, known.lengths[window], known)
    return starts, stops, first, begin[same], window[same]


def spelled_alike(data, starts, stops, symbol, begin, length, known: Windows) -> np.ndarray:
    """Whether the words of each occurrence have the bytes that their hashes stand for."""
    owner = np.repeat(np.arange(len(begin)), length)
    word = np.repeat(begin - np.cumsum(length) + length, length) + np.arange(length.sum())
    used, back = np.unique(word, return_inverse=True)
    entry = symbol[used] - 1
    sizes = stops[used] - starts[used]
    alike = sizes == np.diff(known.spelled_at)[entry]
    check = np.flatnonzero(alike)
    sizes, total = sizes[check], sizes[check].sum()
    inside = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    mine = LOWER[data[np.repeat(starts[used[check]], sizes) + inside]]
    theirs = known.spelled[np.repeat(known.spelled_at[entry[check]], sizes) + inside]
    alike[check[np.repeat(np.arange(len(check)), sizes)[mine != theirs]]] = False
    good = np.ones(len(begin), bool)
    good[owner[~alike[back]]] = False
    return good


def merged_runs(covered: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first words, last words, runs per text) of the runs of covered words in each text."""
    opens, closes = covered.copy(), covered.copy()
    opens[1:] &= ~covered[:-1]
    closes[:-1] &= ~covered[1:]
    cuts = first[1:-1][(first[1:-1] > 0) & (first[1:-1] < len(covered))]
    opens[cuts] = covered[cuts]
    closes[cuts - 1] = covered[cuts - 1]
    opened = np.flatnonzero(opens)
    return opened, np.flatnonzero(closes), np.diff(np.searchsorted(opened, first))


def _search_kernel(shipped, keep: tuple[str, ...]):
    """Adds a block's items, and its hits to the spans found by the blocks before it."""

    @lean
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, SLICE_BYTES):
            known = shipped.value
            data, offsets = raw(binary(batch.column("text")))
            starts, stops, first, begin, window = find_windows(data, offsets, known)
            size = len(offsets) - 1
            step = np.zeros(len(starts) + 1, np.int64)
            np.add.at(step, begin, 1)
            np.add.at(step, begin + known.lengths[window], -1)
            covered = np.cumsum(step[:-1]) > 0
            spans = batch.column("spans")
            old = spans.flatten()
            shift = np.repeat(offsets[:-1], spans.value_lengths().to_numpy(zero_copy_only=False))
            for a, b in zip(old.field("start").to_numpy() + shift, old.field("stop").to_numpy() + shift):
                covered[np.searchsorted(starts, a) : np.searchsorted(starts, b)] = True
            opened, closed, runs = merged_runs(covered, first)
            text = np.repeat(np.arange(size), runs)
            ends = pa.array(np.concatenate([[0], np.cumsum(runs)]).astype(np.int32))
            made = pa.StructArray.from_arrays(
                [pa.array(starts[opened] - offsets[text]), pa.array(stops[closed] - offsets[text])], ["start", "stop"]
            )
            text_of = np.searchsorted(first, begin, "right") - 1
            names = [set(row) for row in batch.column("items").to_pylist()]
            for row, hit in np.unique(np.stack([text_of, window], axis=1), axis=0) if len(begin) else ():
                names[row].update(known.names[item] for item in known.items[hit])
            totals = np.concatenate([[0], np.cumsum(covered)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text"),
                    pa.array(np.diff(first)),
                    pa.array(totals[first[1:]] - totals[first[:-1]]),
                    pa.array([sorted(name for name in row if name is not None) for row in names], pa.list_(pa.string())),
                    pa.ListArray.from_arrays(ends, made),
                    *[batch.column(name) for name in keep],
                ],
                ["doc_id", "text", "n_words", "n_hit", "items", "spans", *keep],
            )

    return kernel


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 10, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text, n_words, n_hit, items, spans of every row of ``docs`` (doc_id, text).

    Words are runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z
    lower-cased. A window is ``size`` consecutive words of an item; an item of fewer words is
    one window. ``items`` are the ids, as text and sorted, of the items a window of which
    occurs; ``spans`` are the merged removal spans (start, stop) in bytes of the UTF-8 text,
    from the first to the last word of a run of hit words. Null texts have no words; an item
    with a null id marks words but is not listed; repeated items are one. An empty table on
    either side gives no row or no hit. Of the other columns those in ``keep`` come last.

    Documents are not shuffled. The benchmark is measured, and sent to the tasks in blocks of
    about ``BLOCK_BYTES``, one pass of the scan's rows per block.
    """
    spark = prepare(docs.sparkSession)
    total = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + int(total) // BLOCK_BYTES
    kind = dict(docs.dtypes)["doc_id"]
    schema = (
        f"doc_id {kind}, text string, n_words long, n_hit long, items array<string>, "
        "spans array<struct<start: long, stop: long>>"
    ) + "".join(f", `{name}` {dict(docs.dtypes)[name]}" for name in keep)
    result = docs.select(
        "doc_id",
        "text",
        F.array().cast("array<string>").alias("items"),
        F.array().cast("array<struct<start: long, stop: long>>").alias("spans"),
        *keep,
    )
    for block in range(blocks):
        part = benchmark.select("item_id", "text").filter(
            F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block
        )
        known = windows_of([(row.item_id, row.text) for row in part.collect()], size)
        shipped = spark.sparkContext.broadcast(known)
        result = result.select("doc_id", "text", "items", "spans", *keep).mapInArrow(
            _search_kernel(shipped, keep), schema
        )
    return result


@lean
def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for row, spans in enumerate(batch.column("spans").to_pylist()):
            if spans:
                at = [0, *[end for span in spans for end in (span["start"], span["stop"])], len(texts[row])]
                texts[row] = b"".join(texts[row][a:b] for a, b in zip(at[::2], at[1::2]))
        names = [name for name in batch.schema.names if name not in ("text", "spans")]
        made = pa.array(texts, pa.binary()).cast(pa.string())
        yield pa.RecordBatch.from_arrays([made, *map(batch.column, names)], ["text", *names])


def without_spans(found: DataFrame) -> DataFrame:
    """``found`` (text, spans and other columns) with the spans cut out of the text, without ``spans``."""
    fields = "".join(f", `{name}` {kind}" for name, kind in found.dtypes if name not in ("text", "spans"))
    return found.mapInArrow(_cut, f"text string{fields}")


@query()
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all windows of 10 words of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    found = contamination(documents(spark, sf_dir).select("doc_id", "text"), benchmark, 10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
