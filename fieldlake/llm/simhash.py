"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints of 64 bits meet in ``2 ** (radius + 1) - 1`` tables. Table ``v`` keeps the bits
whose vector has an odd product with ``v``; any ``radius`` bits span too small a space to
have an odd product with every ``v``, so two fingerprints that differ there agree in a table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlake.llm.common import LOWER, documents, drop, lean, prepare, stored, text_slices
from fieldlake.llm.components import components
from fieldlake.llm.registry import query

SEED = 42
SLICE_BYTES = 4 << 20
#: A bucket with more fingerprints is searched by flipping bits instead of in one piece.
BUCKET = 1024
_LOWER = LOWER.tobytes()


def fingerprint(text: bytes, words_per_shingle: int) -> int:
    """SimHash of a text: a bit is 1 if set in over half of the shingles' hashes."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < words_per_shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    stops = np.cumsum(lengths + 1) - 1
    starts = (stops - lengths)[: len(words) - words_per_shingle + 1].tolist()
    stops = stops[words_per_shingle - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts, size = np.zeros(64, np.int64), len(starts)
    for at in range(0, size, 1 << 18):
        part = [digest(joined[a:b], SEED) for a, b in zip(starts[at : at + (1 << 18)], stops[at : at + (1 << 18)])]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > size, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words_per_shingle: int) -> DataFrame:
    """doc_id and fingerprint (long, the 64 bits) of every row of ``docs`` (doc_id, text)."""
    prepare(docs.sparkSession)

    @lean
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, SLICE_BYTES):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            made = np.array([fingerprint(text or b"", words_per_shingle) for text in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made.view(np.int64))], ["doc_id", "fingerprint"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(kernel, f"doc_id {kind}, fingerprint long")


def covering_masks(radius: int) -> list[int]:
    """One mask of kept bits per table, as signed 64-bit numbers."""
    vectors = (1 << (radius + 1)) - 1
    masks = []
    for table in range(1, vectors + 1):
        mask = sum(1 << bit for bit in range(64) if bin((1 + bit % vectors) & table).count("1") % 2)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


def _distances(values: np.ndarray) -> np.ndarray:
    return np.bitwise_count(values[:, None] ^ values[None, :])


def _bucket_links(radius: int):
    """Links that connect what is within the radius in each bucket, as few as do so."""

    @lean
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends: list[np.ndarray] = []
            members = batch.column("members")
            for row in range(batch.num_rows):
                fields = members[row].values
                prints = fields.field("fingerprint").to_numpy().view(np.uint64)
                nodes = fields.field("node").to_numpy()
                near = _distances(prints) <= radius
                group = np.arange(len(nodes))
                while True:  # each member takes the least group among those near it
                    new = np.where(near, group[None, :], len(nodes)).min(axis=1)
                    if (new == group).all():
                        break
                    group = new
                moved = np.flatnonzero(group != np.arange(len(nodes)))
                if len(moved):
                    ends.append(np.stack([nodes[moved], nodes[group[moved]]]))
            u, v = np.concatenate(ends, axis=1) if ends else np.zeros((2, 0), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return kernel


def near_links(prints: DataFrame, radius: int) -> DataFrame:
    """(u, v): links that connect all nodes of ``prints`` (node, fingerprint) within ``radius``.

    Fingerprints must be distinct. Every linked pair is connected, not every pair is listed.
    A bucket above ``BUCKET`` members is not brought together: its members look up all their
    neighbours that differ in the bits the table leaves out.
    """
    masks = covering_masks(radius)
    tables = F.explode(F.array(*[F.struct(F.lit(n).alias("n"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("key")) for n, m in enumerate(masks)]))
    placed = prints.select("node", "fingerprint", tables.alias("table")).select("node", "fingerprint", "table.*")
    sizes = placed.groupBy("n", "key").count().filter("count > 1")
    small = (
        placed.join(sizes.filter(F.col("count") <= BUCKET), ["n", "key"])
        .groupBy("n", "key")
        .agg(F.array_sort(F.collect_list(F.struct("node", "fingerprint"))).alias("members"))
        .select("members")
        .mapInArrow(_bucket_links(radius), "u long, v long")
    )
    large = placed.join(sizes.filter(F.col("count") > BUCKET), ["n", "key"])
    flips = F.lit(None).cast("array<bigint>")
    for n, mask in enumerate(masks):
        free = [bit for bit in range(64) if not (mask >> bit) & 1]
        made = [sum(1 << b for b in bits) for size in range(1, radius + 1) for bits in combinations(free, size)]
        signed = np.array(made, np.uint64).view(np.int64).tolist()
        flips = F.when(F.col("n") == n, F.array(*[F.lit(x) for x in signed])).otherwise(flips)
    probes = large.select("node", F.col("fingerprint").alias("own"), F.explode(flips).alias("flip")).select(
        "node", F.col("own").bitwiseXOR(F.col("flip")).alias("fingerprint")
    )
    met = probes.join(prints.withColumnRenamed("node", "other"), "fingerprint")
    return small.union(met.select(F.col("node").alias("u"), F.col("other").alias("v")))


def near_duplicates(
    docs: DataFrame, words_per_shingle: int = 3, radius: int = 2, keep: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, fingerprint, component_id, component of every row of ``docs``, then columns in ``keep``.

    Fingerprints link at ``radius`` or fewer differing bits. ``component`` is the least
    fingerprint reachable, as 16 hex digits of a signed number, and names the group;
    component_id is the group's least doc_id. A null or empty text has fingerprint 0 and links
    like any other. Rows of one doc_id are judged each by its fingerprint. Rows with a null
    doc_id take part like others; in a group without any id component_id is null. An empty
    table gives no row, and other columns are not read.
    """
    spark = prepare(docs.sparkSession)
    packed = docs.select(F.struct("doc_id", *keep).alias("doc_id"), "text")
    rows, _ = stored(fingerprints(packed, words_per_shingle).select("doc_id.*", "fingerprint"), "fingerprints")
    nodes, at = stored(
        rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least")).withColumn("node", F.col("fingerprint")),
        "fingerprint-nodes",
    )
    found = components(near_links(nodes, radius))
    joined, placed_at = stored(
        nodes.join(found, "node", "left").select("fingerprint", "least", F.coalesce("component", "node").alias("component")),
        "fingerprint-components",
    )
    ids = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    classes, _ = stored(
        joined.join(ids, "component").select("fingerprint", "component", "component_id"), "fingerprint-classes"
    )
    drop(spark, at, placed_at)
    digits = lambda name: F.lpad(F.lower(F.hex(name)), 16, "0").alias(name)
    return rows.join(classes, "fingerprint").select(
        "doc_id", digits("fingerprint"), "component_id", digits("component"), *keep
    )


@query()
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents by 3-word shingles, linked at 2 or fewer bits."""
    found = near_duplicates(documents(spark, sf_dir).select("doc_id", "text"), 3, 2)
    return found.select("doc_id", "fingerprint", "component_id")
