"""Suffix-array dedup: bytes covered by long strings that start in an earlier document too.

Equal strings of ``length`` bytes have equal anchors (their ``GRAM``-byte substring of least
hash), so text is cut where the anchor changes and the pieces of one anchor meet in one
bucket. Of the anchors, only those seen in two documents send their pieces. In a bucket the
distinct pieces of an anchor that has several are sorted shard by shard into Burrows-Wheeler transforms, and the
transforms are merged by iterative interleave refinement: each round sorts the interleaving
by one more symbol through the transforms alone. After ``length`` rounds a block of the
interleaving is an interval of suffixes with a common prefix of that length; the suffixes
are not sorted again.

Blocks of documents ask, buckets answer: a message is one row per block and bucket with
packed numbers, and an answer is one row of bits in the same order. The text itself is
written once, bucketed by block, and is not shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlake.llm.common import BLOCK_BYTES, binary, documents, drop, lean, prepare, raw, span_hashes, stored, text_slices, window_hashes
from fieldlake.llm.registry import query
from fieldlake.session import scratch_path

GRAM = 24
#: Bytes whose hashes are in memory at once (few, so that they stay near the core), longest piece, and the sizes aimed at.
CHUNK = 1 << 17
PIECE = 48
ANCHORS_PER_BUCKET = 400_000
PIECES_PER_BUCKET = 12_000
SHARD_SYMBOLS = 1 << 18
_LAST = np.iinfo(np.int64).max


@dataclass
class Pieces:
    """Runs of string starts with one anchor: place of the first, how many, anchor, text."""

    start: np.ndarray
    count: np.ndarray
    anchor: np.ndarray
    text: np.ndarray


def _slide(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every window of ``width`` values."""
    made, have = values, 1
    while have * 2 <= width:
        made = np.minimum(made[: len(made) - have], made[have:])
        have *= 2
    rest = width - have
    return np.minimum(made[: len(made) - rest], made[rest:]) if rest else made


def cut_pieces(data: np.ndarray, offsets: np.ndarray, length: int) -> Pieces:
    """Pieces of packed texts; every start of a ``length``-byte string is in one piece."""
    found: list[tuple[np.ndarray, ...]] = []
    at, total = 0, len(data)
    gram = min(GRAM, length)
    while at + length <= total:
        stop = min(total, at + CHUNK + length - 1)
        anchors = _slide(window_hashes(data[at:stop], gram), length - gram + 1)
        fresh = np.ones(len(anchors), bool)
        np.not_equal(anchors[1:], anchors[:-1], out=fresh[1:])
        low, high = np.searchsorted(offsets, [at, at + len(anchors)])
        fresh[offsets[low:high] - at] = True
        runs = np.flatnonzero(fresh)
        sizes = np.diff(runs, append=len(anchors))
        parts = -(-sizes // PIECE)
        if parts.max() > 1:
            run = np.repeat(np.arange(len(runs)), parts)
            nth = np.arange(len(run)) - np.repeat(np.cumsum(parts) - parts, parts)
            runs, sizes = runs[run] + nth * PIECE, np.minimum(sizes[run] - nth * PIECE, PIECE)
        text = np.searchsorted(offsets, runs + at, "right") - 1
        # starts of whole strings come first in a piece
        counts = np.minimum(offsets[text + 1] - length + 1 - (runs + at), sizes)
        inside = counts > 0
        found.append((runs[inside] + at, counts[inside], anchors[runs[inside]], text[inside]))
        at += len(anchors)
    if not found:
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))]
    return Pieces(*(np.concatenate(parts) for parts in zip(*found)))


def _deal(anchors: np.ndarray, buckets: int) -> np.ndarray:
    mixed = anchors * np.uint64(0x9FB21C651E98DF25)
    return ((mixed >> np.uint64(24)) % np.uint64(buckets)).astype(np.int64)


def _by_number(numbers: np.ndarray, count: int) -> np.ndarray:
    """Stable order of numbers below ``count``."""
    return np.argsort(numbers.astype(np.uint16) if count <= 1 << 16 else numbers, kind="stable")


def _same(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order by key, where each key begins in it, which key each row has)."""
    order = np.argsort(keys)
    ranked = keys[order]
    fresh = np.ones(len(order), bool)
    np.not_equal(ranked[1:], ranked[:-1], out=fresh[1:])
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(fresh) - 1
    return order, np.flatnonzero(fresh), which


def ask_anchors(pieces: Pieces, buckets: int):
    """(bucket, anchor, in two texts, piece's anchor) with distinct anchors by bucket."""
    order, firsts, owner = _same(pieces.anchor)
    if not len(order):  # no text is long enough
        return owner, pieces.anchor, np.zeros(0, bool), owner
    text = pieces.text[order]
    anchors = pieces.anchor[order[firsts]]
    shared = np.minimum.reduceat(text, firsts) != np.maximum.reduceat(text, firsts)
    bucket = _deal(anchors, buckets)
    dealt = _by_number(bucket, buckets)
    back = np.empty(len(dealt), np.int64)
    back[dealt] = np.arange(len(dealt))
    return bucket[dealt], anchors[dealt], shared[dealt], back[owner]


def _groups(bucket: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(bucket, first, end) of each run of equal buckets."""
    if not len(bucket):
        return
    cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
    yield from zip(bucket[cuts[:-1]].tolist(), cuts[:-1].tolist(), cuts[1:].tolist())


def _read_block(table: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """A block's rows in a fixed order, with the packed texts."""
    order = pc.sort_indices(table, sort_keys=[("doc_id", "ascending"), ("text", "ascending")])
    table = table.take(order)
    data, offsets = raw(binary(table.column("text")))
    return table, data, offsets


def _packed(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.Table:
    return pa.table({name: pa.array([row[k] for row in rows], kind) for k, (name, kind) in enumerate(zip(names, kinds))})


def _narrow(anchors: np.ndarray) -> np.ndarray:
    """Five bytes of each anchor, which tell a bucket's anchors apart; a rare clash only makes work."""
    return np.ascontiguousarray(anchors.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5])


def _widen(value: pa.Scalar) -> np.ndarray:
    narrow = np.frombuffer(value.as_buffer(), np.uint8).reshape(-1, 5)
    wide = np.zeros((len(narrow), 8), np.uint8)
    wide[:, :5] = narrow
    return wide.view("<u8").ravel()


_ASK = "bucket long, block long, anchors binary, shared binary"


def _ask(length: int, buckets: int):
    def kernel(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        table, data, offsets = _read_block(table)
        bucket, anchors, shared, _ = ask_anchors(cut_pieces(data, offsets, length), buckets)
        narrow = _narrow(anchors)
        rows = [
            (number, block, narrow[a:b].tobytes(), np.packbits(shared[a:b]).tobytes()) for number, a, b in _groups(bucket)
        ]
        return _packed(rows, ["bucket", "block", "anchors", "shared"], [pa.int64(), pa.int64(), pa.binary(), pa.binary()])

    return kernel


_ANSWER = "kind int, bucket long, block long, bits binary, marked long"


def _answer_rows(kind: int, rows: list[tuple]) -> pa.Table:
    return _packed(
        [(kind, *row) for row in rows],
        ["kind", "bucket", "block", "bits", "marked"],
        [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64()],
    )


def _answer_anchors(table: pa.Table) -> pa.Table:
    """Which anchors of each block occur in two documents."""
    bucket, blocks = table.column("bucket")[0].as_py(), table.column("block").to_pylist()
    parts = [_widen(value) for value in table.column("anchors")]
    shared = [
        np.unpackbits(np.frombuffer(value.as_buffer(), np.uint8), count=len(part)).astype(bool)
        for value, part in zip(table.column("shared"), parts)
    ]
    _, which, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    repeated = counts > 1
    repeated[which[np.concatenate(shared)]] = True
    marked = repeated[which]
    ends = np.cumsum([0, *map(len, parts)])
    return _answer_rows(
        1,
        [
            (bucket, block, np.packbits(marked[a:b]).tobytes(), int(marked[a:b].sum()))
            for block, a, b in zip(blocks, ends[:-1], ends[1:])
        ],
    )


def _bits_by_bucket(answers: pa.Table, kind: int) -> dict[int, bytes]:
    rows = answers.filter(pc.equal(answers.column("kind"), kind))
    return dict(zip(rows.column("bucket").to_pylist(), rows.column("bits").to_pylist()))


def repeated_pieces(data, offsets, length: int, answers: pa.Table, buckets: int, next_buckets: int):
    """Pieces of anchors in two documents, dealt to the second buckets: (pieces, bucket)."""
    pieces = cut_pieces(data, offsets, length)
    bucket, anchors, _, owner = ask_anchors(pieces, buckets)
    bits = _bits_by_bucket(answers, 1)
    marked = np.zeros(len(bucket), bool)
    for number, a, b in _groups(bucket):
        marked[a:b] = np.unpackbits(np.frombuffer(bits[number], np.uint8), count=b - a)
    kept = np.flatnonzero(marked[owner]) if len(owner) else owner
    dealt = _deal(pieces.anchor[kept] ^ np.uint64(0xA5A5A5A5A5A5A5A5), next_buckets)
    order = _by_number(dealt, next_buckets)
    kept = kept[order]
    return Pieces(pieces.start[kept], pieces.count[kept], pieces.anchor[kept], pieces.text[kept]), dealt[order]


def _take(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    return data[np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]


def _size_type(length: int) -> type:
    """What holds the size of a piece, the narrowest for the many pieces there are."""
    return np.uint8 if PIECE + length <= 256 else np.uint32


_SEND = "bucket long, block long, strings binary, sizes binary, anchors binary, which binary, doc binary"


def _send(length: int, buckets: int, next_buckets: int):
    def kernel(table: pa.Table, answers: pa.Table) -> pa.Table:
        rows = []
        if table.num_rows:
            block = table.column("block")[0].as_py()
            table, data, offsets = _read_block(table)
            pieces, bucket = repeated_pieces(data, offsets, length, answers, buckets, next_buckets)
            ids = table.column("doc_id").fill_null(_LAST).to_numpy()
            sizes = pieces.count + length - 1
            keys = _piece_keys(data, pieces.start, sizes)
            for number, a, b in _groups(bucket):
                order, begins, which = _same(keys[a:b])
                first = order[begins]
                strings = _take(data, pieces.start[a:b][first], sizes[a:b][first])
                rows.append(
                    (
                        number,
                        block,
                        zstandard.compress(strings.tobytes(), 1),
                        sizes[a:b][first].astype(_size_type(length)).tobytes(),
                        _narrow(pieces.anchor[a:b][first]).tobytes(),
                        which.astype(np.uint32).tobytes(),
                        ids[pieces.text[a:b]].tobytes(),
                    )
                )
        names = ["bucket", "block", "strings", "sizes", "anchors", "which", "doc"]
        return _packed(rows, names, [pa.int64(), pa.int64(), *[pa.binary()] * 5])

    return kernel


def _piece_keys(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hashes of pieces, chunk by chunk of the text."""
    made = np.zeros(len(starts), np.uint64)
    order = np.argsort(starts)
    longest = int(sizes.max(initial=0))
    for low, a, b in _groups(starts[order] // CHUNK):
        part, base = order[a:b], low * CHUNK
        made[part] = span_hashes(data[base : base + CHUNK + longest], starts[part] - base, starts[part] - base + sizes[part])
    return made


@dataclass
class Transform:
    """A shard's Burrows-Wheeler transform, its step to the row before, and its suffixes."""

    symbols: np.ndarray
    step: np.ndarray
    suffix: np.ndarray
    ends: int


def transform(text: np.ndarray) -> Transform:
    """Transform of strings that end in 0, one after another.

    Suffixes end with their string; equal ones are in the order of their strings.
    """
    n = len(text)
    stops = np.flatnonzero(text == 0)
    left = np.repeat(stops, np.diff(np.concatenate([[-1], stops]))) - np.arange(n)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | np.where(left >= k, padded[k : k + n], 0).astype(np.uint64)
    width = 8
    while True:
        order = np.argsort(key)
        ranked = key[order]
        fresh = np.ones(n, bool)
        np.not_equal(ranked[1:], ranked[:-1], out=fresh[1:])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh)
        if width > left.max(initial=0) or fresh.all():
            order = np.argsort(rank * n + np.arange(n))
            break
        behind = np.where(left >= width, rank[np.minimum(np.arange(n) + width, n - 1)], 0)
        key = rank.astype(np.uint64) * np.uint64(n + 2) + behind.astype(np.uint64)
        width *= 2
    symbols = text[order - 1]
    row = np.empty(n, np.int64)
    row[order] = np.arange(n)
    return Transform(symbols, row[order - 1], order, len(stops))


def interleave(shards: list[Transform], rows: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(merged order of the suffixes ``depth`` symbols before ``rows``, block of each) after refinement to ``depth``.

    Rows count through the shards; those given have ``depth`` symbols of their string before them.
    Only these are interleaved, as a round takes each one symbol back. Rows of one block have the same
    first ``depth`` symbols.
    """
    sizes = [len(shard.symbols) for shard in shards]
    base = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    symbols = np.concatenate([shard.symbols for shard in shards])
    step = np.concatenate([shard.step + start for shard, start in zip(shards, base)]).astype(np.int32)
    rows, blocks = rows.astype(np.int32), np.zeros(len(rows), np.int32)
    fresh = np.zeros(len(rows), bool)
    for _ in range(depth):
        symbol = symbols[rows]
        order = np.argsort(symbol, kind="stable")
        symbol, blocks = symbol[order], blocks[order]
        fresh[1:] = (symbol[1:] != symbol[:-1]) | (blocks[1:] != blocks[:-1])
        rows, blocks = step[rows[order]], np.cumsum(fresh, dtype=np.int32)
    return rows, blocks


def least_owner(strings: np.ndarray, sizes: np.ndarray, owner: np.ndarray, length: int) -> np.ndarray:
    """For every start of a ``length``-byte string in the given strings, its least owner.

    ``strings`` are distinct byte strings one after another. The result has the starts of
    each string in order, one string after another.
    """
    used = np.bincount(strings, minlength=256) > 0
    code = np.cumsum(used).astype(np.uint8)  # UTF-8 has fewer than 255 byte values
    if used.sum() > 255:
        raise ValueError("texts use more byte values than UTF-8 has")
    n = len(strings) + len(sizes)
    stops = np.cumsum(sizes + 1) - 1
    text = np.zeros(n, np.uint8)
    body = np.ones(n, bool)
    body[stops] = False
    text[body] = code[strings]
    cuts, last = [0], 0
    for stop in stops:
        if stop + 1 - last > SHARD_SYMBOLS:
            cuts.append(int(stop) + 1)
            last = int(stop) + 1
    if cuts[-1] != n:
        cuts.append(n)
    shards = [transform(text[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
    suffix = np.concatenate([shard.suffix + a for shard, a in zip(shards, cuts)])
    string = np.repeat(np.arange(len(sizes)), sizes + 1)
    inside = np.arange(n) - (stops - sizes)[string]
    rows, blocks = interleave(shards, np.flatnonzero(inside[suffix] >= length), length)
    place = suffix[rows]
    fresh = np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1]))
    least = np.minimum.reduceat(owner[string[place]], fresh)
    made = np.full(n, _LAST)
    made[place] = np.repeat(least, np.diff(np.append(fresh, len(place))))
    return made[np.flatnonzero(stops[string] - np.arange(n) >= length)]


def _answer_pieces(length: int):
    """For each piece of each block, which starts also start in an earlier document."""

    def kernel(table: pa.Table) -> pa.Table:
        bucket, blocks = table.column("bucket")[0].as_py(), table.column("block").to_pylist()
        read = lambda name, kind: [np.frombuffer(v.as_buffer(), kind) for v in table.column(name)]
        strings = [np.frombuffer(zstandard.decompress(v.as_buffer()), np.uint8) for v in table.column("strings")]
        sizes, which, docs = read("sizes", _size_type(length)), read("which", np.uint32), read("doc", np.int64)
        shift = np.cumsum([0, *map(len, sizes)])
        which = [part.astype(np.int64) + start for part, start in zip(which, shift)]
        all_sizes = np.concatenate(sizes).astype(np.int64)
        offsets = np.concatenate([[0], np.cumsum(all_sizes)])
        coded = pa.BinaryArray.from_buffers(
            pa.binary(), len(all_sizes), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.concatenate(strings))]
        ).dictionary_encode()
        same = coded.indices.to_numpy().astype(np.int64)
        data, at = raw(coded.dictionary)
        owner = np.full(len(coded.dictionary), _LAST)
        np.minimum.at(owner, same[np.concatenate(which)], np.concatenate(docs))
        anchors = np.zeros(len(owner), np.uint64)
        anchors[same] = np.concatenate([_widen(value) for value in table.column("anchors")])
        starts = np.diff(at) - length + 1
        first = np.concatenate([[0], np.cumsum(starts)])
        # a string that is the only one of its anchor shares its starts with no other
        _, group, members = np.unique(anchors, return_inverse=True, return_counts=True)
        merged = members[group] > 1
        least = np.repeat(owner, starts)
        if merged.any():
            sizes_of = np.diff(at)[merged]
            strings_of = data[np.repeat(merged, np.diff(at))]
            least[np.repeat(merged, starts)] = least_owner(strings_of, sizes_of, owner[merged], length)
        rows = []
        for block, part, doc in zip(blocks, which, docs):
            string = same[part]
            counts = starts[string]
            ends = np.cumsum(counts)
            inside = np.arange(ends[-1]) - np.repeat(ends - counts, counts)
            earlier = least[np.repeat(first[string], counts) + inside] < np.repeat(doc, counts)
            bits = np.packbits(earlier)
            rows.append((bucket, block, bits.tobytes(), int(earlier.sum())))
        return _answer_rows(2, rows)

    return kernel


def covered_bytes(size: int, pieces: Pieces, earlier: np.ndarray, length: int) -> np.ndarray:
    """Which bytes lie in a string that starts in an earlier document."""
    ends = np.cumsum(pieces.count)
    place = np.repeat(pieces.start - ends + pieces.count, pieces.count) + np.arange(ends[-1] if len(ends) else 0)
    place = place[earlier]
    step = np.zeros(size + 1, np.int8)  # a start is in one piece only
    step[place] += 1
    step[place + length] -= 1
    return np.cumsum(step[:-1], dtype=np.int32) > 0


def _remove(length: int, buckets: int, next_buckets: int, keep: tuple[str, ...]):
    def kernel(table: pa.Table, answers: pa.Table) -> pa.Table:
        table, data, offsets = _read_block(table)
        pieces, bucket = repeated_pieces(data, offsets, length, answers, buckets, next_buckets)
        bits = _bits_by_bucket(answers, 2)
        earlier = np.zeros(int(pieces.count.sum()), bool)
        ends = np.concatenate([[0], np.cumsum(pieces.count)])
        for number, a, b in _groups(bucket):
            size = int(ends[b] - ends[a])
            earlier[ends[a] : ends[b]] = np.unpackbits(np.frombuffer(bits[number], np.uint8), count=size)
        gone = covered_bytes(len(data), pieces, earlier, length)
        opens, closes = gone.copy(), gone.copy()
        opens[1:] &= ~gone[:-1]
        closes[:-1] &= ~gone[1:]
        edges = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
        opens[edges], closes[edges - 1] = gone[edges], gone[edges - 1]
        opened, closed = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        spans = np.searchsorted(opened, offsets)
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(spans))
        left = np.concatenate([[0], np.cumsum(~gone)])[offsets]
        kept = pa.BinaryArray.from_buffers(
            pa.binary(), len(offsets) - 1, [None, pa.py_buffer(left.astype(np.int32)), pa.py_buffer(data[~gone])]
        )
        made = pa.StructArray.from_arrays(
            [pa.array(opened - offsets[text]), pa.array(closed - offsets[text])], ["start", "stop"]
        )
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "n_bytes": np.diff(offsets),
                "kept": kept,
                "spans": pa.ListArray.from_arrays(pa.array(spans.astype(np.int32)), made),
                **{name: table.column(_kept(name)) for name in keep},
            }
        )

    return kernel


def _kept(name: str) -> str:
    return f"kept_{name}"


@lean
def _in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the rows by blocks of about ``BLOCK_BYTES`` of text."""
    block, size = TaskContext.get().partitionId() << 32, 0
    for batch in text_slices(batches, BLOCK_BYTES):
        length = pc.sum(pc.binary_length(batch.column("text"))).as_py() or 0
        if size and size + length > BLOCK_BYTES:
            block, size = block + 1, 0
        size += length
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(batch.num_rows, block)), *batch.columns], ["block", *batch.schema.names]
        )


def remove_repeats(docs: DataFrame, length: int = 50, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_bytes, kept (binary), spans of every row of ``docs`` (doc_id long, text).

    A byte goes where a string of ``length`` bytes over it also starts in a document with a
    smaller doc_id; strings are those of the input. ``spans`` are the maximal removed runs
    (start, stop) in bytes. A null text counts as empty; null ids are after all others and
    alike; rows of one id do not remove each other's bytes. An empty table gives no row. Of
    the other columns those in ``keep`` come last. The result is stored in the shared folder.
    """
    spark = prepare(docs.sparkSession)
    kinds = {name: dict(docs.dtypes)[name] for name in keep}
    name, place = f"blocks_{uuid.uuid4().hex}", scratch_path(spark, "blocks")
    cells = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8)
    (
        docs.select(F.col("doc_id").cast("long"), "text", *[F.col(name).alias(_kept(name)) for name in keep])
        .mapInArrow(
            _in_blocks,
            "block long, doc_id long, text string" + "".join(f", `{_kept(name)}` {kind}" for name, kind in kinds.items()),
        )
        .write.bucketBy(cells, "block")
        .option("path", place)
        .option("compression", "zstd")
        .saveAsTable(name)
    )
    blocks = spark.table(name)
    size = blocks.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    density = 2 / (length - min(GRAM, length) + 2)
    buckets = max(16, -(-int(size * density) // ANCHORS_PER_BUCKET))
    by_bucket = "bucket"
    by_block = blocks.select("block", "doc_id", "text").groupBy("block")
    asked = by_block.applyInArrow(_ask(length, buckets), _ASK)
    answers, first = stored(asked.groupBy(by_bucket).applyInArrow(_answer_anchors, _ANSWER), "anchor-answers")
    marked = answers.agg(F.sum("marked")).first()[0] or 0
    next_buckets = max(16, -(-int(marked) // PIECES_PER_BUCKET))
    sent = by_block.cogroup(answers.groupBy("block")).applyInArrow(_send(length, buckets, next_buckets), _SEND)
    pieces, second = stored(sent.groupBy(by_bucket).applyInArrow(_answer_pieces(length), _ANSWER), "piece-answers")
    told = answers.union(pieces).groupBy("block")
    result, _ = stored(
        blocks.groupBy("block").cogroup(told).applyInArrow(
            _remove(length, buckets, next_buckets, keep),
            "doc_id long, n_bytes long, kept binary, spans array<struct<start: long, stop: long>>"
            + "".join(f", `{name}` {kind}" for name, kind in kinds.items()),
        ),
        "without-repeats",
    )
    spark.sql(f"DROP TABLE {name}")
    drop(spark, place, first, second)
    return result


@lean
def _characters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [value.decode("utf-8", "ignore") for value in batch.column("kept").to_pylist()]
        names = [name for name in batch.schema.names if name != "kept"]
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), *map(batch.column, names)], ["text", *names])


def whole_characters(found: DataFrame) -> DataFrame:
    """``found`` with ``kept`` as ``text``, without bytes that are no whole character."""
    fields = "".join(f", `{name}` {kind}" for name, kind in found.dtypes if name != "kept")
    return found.mapInArrow(_characters, f"text string{fields}")


@query()
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes of 50-byte strings of earlier documents."""
    found = remove_repeats(documents(spark, sf_dir).select("doc_id", "text"), 50)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda sum_, s: sum_ + s.stop - s.start)
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
