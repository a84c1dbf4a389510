"""Running totals over sorted ranges that are stored: positions, dense ids, cumulative counts.

A frame is cut into ranges of about ``RANGE_ROWS`` rows by its sort keys, each range is sorted
and given running totals by one task, and the result is stored. What a range needs from the
ranges before it is one row per range, so it is broadcast however large the frame is.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlake.session import materialise

RANGE_ROWS = 1_000_000
#: Columns that mark a row's group.
GROUP = ("_g", "_h")


def _running_kernel(totals: list[str]):
    """Running totals within the group, and whether the group is the first of the range.

    Sees one range in order. The totals of the group that a batch ends in go on in the next.
    """

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, first, carried = None, None, [0] * len(totals)
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = np.stack([batch.column(name).to_numpy() for name in GROUP], axis=1)
            begins = np.ones(len(marks), bool)
            begins[1:] = (marks[1:] != marks[:-1]).any(axis=1)
            begins[0] = last is None or tuple(marks[0]) != last
            first = tuple(marks[0]) if first is None else first
            opened = np.maximum.accumulate(np.where(begins, np.arange(len(marks)), -1))
            columns, after = dict(zip(batch.schema.names, batch.columns)), []
            for name, brought in zip(totals, carried):
                values = batch.column(name).to_numpy().astype(np.int64)
                sums = np.cumsum(values)
                before = np.where(opened < 0, -brought, np.append(0, sums)[opened])
                columns[name] = pa.array(sums - before)
                after.append(int(sums[-1] - before[-1]))
            columns["_first"] = pa.array((marks == first).all(axis=1))
            last, carried = tuple(marks[-1]), after
            yield pa.RecordBatch.from_arrays([*columns.values()], [*columns])

    return kernel


def running_totals(
    df: DataFrame, group: list[str], order: list[Column], totals: dict[str, Column], ties: list[Column] = ()
) -> DataFrame:
    """``df`` with running totals of counts within its group in a stated order, the row included.

    Counts are longs, none of them negative. Rows that are equal in ``group`` and ``order`` come in the order of ``ties``, so a value that
    fills several ranges is split as well. The number of ranges follows the number of rows; a
    group may hold them all. ``df`` is counted, sampled for the cuts, and shuffled once.
    """
    rows = df.count()
    parts = max(1, math.ceil(rows / RANGE_ROWS))
    if parts == 1:  # a range per core, where there is work for them
        parts = max(1, min(df.sparkSession.sparkContext.defaultParallelism, rows // 10_000))
    marks = [F.xxhash64(F.lit(seed), *group).alias(name) for seed, name in enumerate(GROUP)]
    keys = [*[F.col(name) for name in GROUP], *[F.col(f"_k{i}") for i in range(len(order) + len(ties))]]
    wide = df.select(
        "*",
        *marks,
        *[key.alias(f"_k{i}") for i, key in enumerate([*order, *ties])],
        *[value.cast("long").alias(f"_t{i}") for i, value in enumerate(totals.values())],
    )
    names = [f"_t{i}" for i in range(len(totals))]
    sorted_ranges = wide.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    sorted_ranges = sorted_ranges.drop(*[f"_k{i}" for i in range(len(order) + len(ties))])
    kinds = ", ".join(f"`{name}` {kind}" for name, kind in sorted_ranges.dtypes)
    local = sorted_ranges.mapInArrow(_running_kernel(names), f"{kinds}, _first boolean")
    stored = materialise(local.withColumn("_range", F.spark_partition_id()), "ranges")
    # only a group that opens a later range can have rows in an earlier one: a group per range
    spanning = stored.filter("_first").select(*GROUP).distinct()
    ends = stored.join(F.broadcast(spanning), list(GROUP), "left_semi").groupBy(*GROUP, "_range")
    ends = ends.agg(*[F.max(name).alias(name) for name in names])  # running totals do not fall
    before = Window.partitionBy(*GROUP).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = ends.select(
        *GROUP, "_range", *[F.coalesce(F.sum(name).over(before), F.lit(0)).alias(f"_s{name}") for name in names]
    )
    joined = stored.join(F.broadcast(shifts), [*GROUP, "_range"], "left")
    return joined.select(
        *df.columns,
        *[(F.col(name) + F.coalesce(F.col(f"_s{name}"), F.lit(0))).alias(out) for name, out in zip(names, totals)],
    )


def hashable(df: DataFrame) -> list[str]:
    """Columns that can be hashed and sorted by."""
    return [f"`{name}`" for name, kind in df.dtypes if "map<" not in kind and "variant" not in kind]


def number_within(df: DataFrame, group: list[str], order: str | list[str], out: str) -> DataFrame:
    """0-based position of every row within its group, by a numeric or time column.

    More columns after the first one break ties; rows that are equal in all of them come in the
    order of a hash of the row. A group may hold most of the table: it is shared by the tasks
    of as many ranges as it fills. Eager: the numbered rows are stored.
    """
    keys = [order] if isinstance(order, str) else order
    whole = hashable(df)
    ties = [F.xxhash64(*whole), F.xxhash64(F.lit(1), *whole)] if whole else []
    numbered = running_totals(df, group, [F.col(key) for key in keys], {"_number": F.lit(1)}, ties)
    return numbered.withColumn(out, F.col("_number") - 1).drop("_number")


def record_hash(df: DataFrame) -> Column:
    """md5 of a row's values as text, each with its length; null has none."""
    texts = [
        F.to_json(F.struct(f"`{name}`")) if kind[:3] in ("arr", "str", "map") and kind != "string" else F.col(f"`{name}`").cast("string")
        for name, kind in df.dtypes
    ]
    marked = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.md5(F.concat(*marked)) if marked else F.lit("")


def dense_ids(df: DataFrame, out: str) -> DataFrame:
    """Numbers from 0 without gaps, in the order of the rows' hashes; equal rows are neighbours.

    They depend on the rows only, not on their order, files or partitions. Eager.
    """
    hashed = df.withColumn("_hash", record_hash(df))
    numbered = running_totals(hashed, [], [F.col("_hash")], {"_number": F.lit(1)})
    return numbered.withColumn(out, F.col("_number") - 1).drop("_number", "_hash")
