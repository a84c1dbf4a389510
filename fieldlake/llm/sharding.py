"""Sharding by a minimax contiguous partition of ordered atoms.

Rows with equal text are one group and stay together. The text's hash puts a group into one
of ``shards * ATOMS_PER_SHARD`` ordered atoms, so there is a fixed number of sizes to cut,
whatever the number of rows, and one shard is cut at a resolution of a thousandth.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldlake.llm.common import documents, drop, stored
from fieldlake.llm.registry import query

ATOMS_PER_SHARD = 1024
ROW_OVERHEAD = 16
SLOT_ROWS = 200_000


def reach(prefix: np.ndarray, start: int, capacity: int) -> int:
    """End of the longest run of atoms from ``start`` whose sizes sum to at most ``capacity``."""
    return int(np.searchsorted(prefix, prefix[start] + capacity, "right")) - 1


def feasible(prefix: np.ndarray, start: int, shards: int, capacity: int) -> bool:
    """Whether the atoms from ``start`` fit into ``shards`` runs, filled greedily."""
    for _ in range(shards):
        if start == len(prefix) - 1:
            return True
        start = reach(prefix, start, capacity)
    return start == len(prefix) - 1


def smallest_capacity(prefix: np.ndarray, shards: int) -> int:
    """Least capacity for which the greedy check needs at most ``shards`` runs."""
    low, high = int(np.diff(prefix).max(initial=0)), int(prefix[-1])
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if feasible(prefix, 0, shards, middle) else (middle + 1, high)
    return low


def cut(sizes: np.ndarray, shards: int) -> list[int]:
    """Starts of at most ``shards`` runs under the smallest capacity, as even as it allows.

    A greedy filling leaves the last runs empty, so each run ends as near to an even share of
    what is left as the capacity permits for itself and for the runs after it.
    """
    prefix = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    atoms, capacity = len(sizes), smallest_capacity(prefix, shards)
    starts, start = [], 0
    for left in range(shards, 0, -1):
        if start >= atoms:
            break
        starts.append(start)
        if left == 1:
            break
        share = prefix[start] + (prefix[-1] - prefix[start]) / left
        near = int(np.searchsorted(prefix, share))
        if near > start + 1 and share - prefix[near - 1] < prefix[min(near, atoms)] - share:
            near -= 1
        far = reach(prefix, start, capacity)
        near = max(start + 1, min(near, far, max(start + 1, atoms - left + 1)))
        while near < far and not feasible(prefix, near, left - 1, capacity):
            near += 1
        start = near
    return starts


def plan_shards(sizes: dict[int, int], shards: int) -> tuple[dict[int, int], list[int]]:
    """(atoms with a shard of their own, first atoms of the other shards).

    An atom above the even share of what is left takes a shard alone: it sets the capacity,
    and the rest is still cut evenly.
    """
    alone: dict[int, int] = {}
    total = sum(sizes.values())
    for atom, size in sorted(sizes.items(), key=lambda item: (-item[1], item[0])):
        left = shards - len(alone)
        if left == 1 or size * left <= total:
            break
        alone[atom] = len(alone)
        total -= size
    rest = sorted(atom for atom in sizes if atom not in alone)
    if not rest:
        return alone, []
    starts = cut(np.array([sizes[atom] for atom in rest], np.int64), shards - len(alone))
    return alone, [rest[start] for start in starts]


def shard_of(atom: Column, alone: dict[int, int], firsts: list[int]) -> Column:
    """Shard of an atom by the planned cuts, as one expression."""
    shard = F.lit(len(alone))
    for first in firsts[1:]:
        shard = shard + (atom >= first).cast("int")
    for own, number in alone.items():
        shard = F.when(atom == own, number).otherwise(shard)
    return shard


def assign_shards(docs: DataFrame, shards: int = 40) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row of ``docs`` (doc_id, text).

    A null text counts as empty. Rows with equal texts share a shard; a shard's slots run
    from 0 without a gap, in a fixed order. An empty table gives no row. Rows that are equal
    in id and text get different slots. Other columns are not read.

    One scan writes the ids, sizes and atoms; sizes by atom are added up before they are
    shuffled, and at most ``shards * ATOMS_PER_SHARD`` sums reach the driver. Slots are
    numbered in pieces of about ``SLOT_ROWS`` rows, shifted by the counts of earlier pieces.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows, path = stored(
        docs.select(
            "doc_id",
            (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.pmod(F.xxhash64(text), F.lit(shards * ATOMS_PER_SHARD)).cast("int").alias("atom"),
        ),
        "shard-rows",
    )
    sums = rows.groupBy("atom").agg(F.sum("size"), F.count("*")).collect()
    alone, firsts = plan_shards({atom: size for atom, size, _ in sums}, shards)
    pieces = max(16, -(-sum(count for *_, count in sums) // (shards * SLOT_ROWS)))
    placed = rows.withColumn("shard", shard_of(F.col("atom"), alone, firsts)).withColumn(
        "piece", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(pieces))
    )
    earlier = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("shard", "piece")
        .count()
        .select("shard", "piece", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    )
    inside = Window.partitionBy("shard", "piece").orderBy("doc_id", "text_crc32", "size")
    result, _ = stored(
        placed.withColumn("row", F.row_number().over(inside))
        .join(offsets, ["shard", "piece"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("row") - 1).alias("slot")),
        "shards",
    )
    drop(spark, path)
    return result


@query()
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes, equal texts together."""
    placed = assign_shards(documents(spark, sf_dir).select("doc_id", "text"), 40)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
