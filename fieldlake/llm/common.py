"""Helpers the operators share: stored tables, packed text blocks, word kernels."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from fieldlake.session import scratch_path, ship_package

#: The ASCII white space of the word rule, and A-Z mapped to a-z.
WHITE = np.zeros(256, bool)
WHITE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_WHITE_BYTES = np.flatnonzero(WHITE).astype(np.uint8).tobytes()

#: Bytes of text per packed block; a longer text is a block of its own.
BLOCK_BYTES = 8 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Ship the package to the executors and bound the bytes of an Arrow batch."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5000")
    return spark


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder, read again, and where it lies. Eager."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path), path


def drop(spark: SparkSession, *paths: str) -> None:
    """Remove stored tables that no later result reads."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def lean(kernel: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``kernel``, after which the worker gives the memory it has freed back to the system.

    A worker waits for its next task for a minute, and chained kernels have one each, so what
    idle workers hold adds up to a good part of an executor.
    """

    @wraps(kernel)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from kernel(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
        if trim:
            trim(0)

    return run


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def binary(column: pa.Array | pa.ChunkedArray) -> pa.BinaryArray:
    """A text column as 32-bit-offset bytes, null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    return column.cast(pa.binary())


def raw(column: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets from 0) of a binary column, without a copy where it has no offset."""
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def bytes_of(values: np.ndarray) -> pa.BinaryArray:
    """One binary value holding an array's bytes."""
    return pa.array([values.tobytes()], pa.binary())


def text_slices(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Cut batches with a ``text`` column into slices of about ``limit`` bytes each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        start = size = 0
        for row, length in enumerate(lengths):
            if row > start and size + length > limit:
                yield batch.slice(start, row - start)
                start, size = row, 0
            size += length
        yield batch.slice(start)


def white_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased white-space words of packed texts.

    Returns the words' bytes one after another, their offsets, and the number of words of
    each text. A word never crosses the end of a text.
    """
    ink = ~WHITE[data]
    starts_here = ink.copy()
    starts_here[1:] &= ~ink[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    starts_here[edges] = ink[edges]
    kept = np.frombuffer(data.tobytes().translate(LOWER.tobytes(), _WHITE_BYTES), np.uint8)
    position = np.flatnonzero(starts_here)
    # a word ends where another begins or white space follows
    ends_here = ink
    ends_here[:-1] &= ~ink[1:] | starts_here[1:]
    word_offsets = np.zeros(len(position) + 1, np.int64)
    np.cumsum(np.flatnonzero(ends_here) + 1 - position, out=word_offsets[1:])
    first = np.searchsorted(position, offsets)
    return kept, word_offsets, np.diff(first)


_ROOT = 0x9E3779B97F4A7C15
_BYTE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.int64).astype(np.uint64)


#: Powers of the base and of its inverse, as many as were needed so far.
_POWERS = {base: np.ones(1, np.uint64) for base in (_ROOT, pow(_ROOT, -1, 1 << 64))}


def _powers(base: int, count: int) -> np.ndarray:
    if len(_POWERS[base]) < count:
        made = np.full(max(count, 1 << 21), base, np.uint64)
        made[0] = 1
        if count > 1 << 21:  # a very long text is not kept in mind
            return np.multiply.accumulate(made)
        _POWERS[base] = np.multiply.accumulate(made)
    return _POWERS[base][:count]


def span_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, times: np.ndarray | None = None) -> np.ndarray:
    """64-bit hashes of spans of bytes: polynomials modulo 2**64 from one running sum.

    The base is odd, so it has an inverse by which a span's sum is moved to its start.
    With ``times`` each start is that of so many stops in a row.
    """
    sums = np.zeros(len(data) + 1, np.uint64)
    terms = _BYTE.take(data)
    terms *= _powers(_ROOT, len(data))
    np.cumsum(terms, out=sums[1:])
    begun, back = sums.take(starts), _powers(pow(_ROOT, -1, 1 << 64), len(data) + 1).take(starts)
    if times is not None:
        starts, begun, back = np.repeat(starts, times), np.repeat(begun, times), np.repeat(back, times)
    hashes = sums.take(stops)
    hashes -= begun
    hashes *= back
    hashes ^= (stops - starts).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    return hashes ^ (hashes >> np.uint64(29))


def window_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """:func:`span_hashes` of every ``width`` bytes."""
    count = max(len(data) - width + 1, 0)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(_ROOT, len(data)), out=sums[1:])
    hashes = sums[width : width + count] - sums[:count]
    hashes *= _powers(pow(_ROOT, -1, 1 << 64), len(data) + 1)[:count]
    hashes ^= np.full(1, width, np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    hashes ^= hashes >> np.uint64(29)
    return hashes


def binary_array(data: np.ndarray, offsets: np.ndarray) -> pa.BinaryArray:
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
    )
