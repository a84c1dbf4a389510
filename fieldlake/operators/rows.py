"""Unions, distinct rows, set-like array aggregates, ranking and ordered limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def union_by_name(left: DataFrame, right: DataFrame) -> DataFrame:
    """All rows of both; absent columns are NULL, columns of differing types become strings."""
    left_types, right_types = dict(left.dtypes), dict(right.dtypes)
    clash = [c for c in left.columns if right_types.get(c, left_types[c]) != left_types[c]]

    def aligned(df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.col(f"`{c}`").cast("string") for c in clash}) if clash else df

    return aligned(left).unionByName(aligned(right), allowMissingColumns=True)


def distinct_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Distinct rows, over the given columns only if any are named."""
    return (df.select(*columns) if columns else df).dropDuplicates()


def sorted_union(*arrays: Column) -> Column:
    """Row-wise sorted union of arrays."""
    return F.array_sort(F.array_distinct(F.concat(*arrays)))


def top_per_group(
    df: DataFrame, group: list[str], order: list[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """The first ``k`` rows per group with their 1-based rank.

    The filter on the row number becomes a per-partition limit ahead of the shuffle, so a group
    holding most of the rows sends at most ``k`` rows per task.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def top_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows in a stated order; each task keeps ``n`` rows, nothing is sorted whole."""
    return df.orderBy(*order).limit(n)
