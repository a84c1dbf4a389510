"""Grouped and global aggregates, pivots, histograms and series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlake.functions.numeric import to_double
from fieldlake.functions.temporal import parse_timestamp
from fieldlake.functions.text import title_words
from fieldlake.operators.ranges import running_totals


def mean_by(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Means per group; rows with a NULL key are left out."""
    return df.dropna(subset=keys).groupBy(*keys).agg(*[F.avg(c).alias(c) for c in columns])


def summarise(df: DataFrame, columns: list[str], keys: list[str] | None = None) -> DataFrame:
    """Count, and mean, minimum and maximum per column, in one aggregate."""
    measures: list[Column] = [F.count(F.lit(1)).alias("n")]
    for c in columns:
        measures += [
            F.avg(c).alias(f"avg_{c}"),
            F.min(c).alias(f"min_{c}"),
            F.max(c).alias(f"max_{c}"),
        ]
    return df.groupBy(*(keys or [])).agg(*measures)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct non-null values as rows."""
    return df.select(column).dropna().distinct().orderBy(column)


def distinct_count(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    """Number of distinct non-null values; a sketch if ``approximate``."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(count(column).alias("n_distinct"))


def holds(df: DataFrame, condition: Column) -> DataFrame:
    """Whether a condition is true for any and for all rows."""
    flag = F.coalesce(condition, F.lit(False))
    return df.agg(F.bool_or(flag).alias("any"), F.bool_and(flag).alias("all"))


def pivot_mean(
    df: DataFrame, row: str, column: Column, value: str, values: list | None = None
) -> DataFrame:
    """Means with one row per ``row`` and one column per value of ``column``.

    Aggregated to (row, column) before the pivot. Known ``values`` save the job that lists them.
    """
    cells = df.groupBy(row, column.alias("_column")).agg(F.avg(value).alias("_mean"))
    return cells.groupBy(row).pivot("_column", values).agg(F.first("_mean"))


def indicator_matrix(
    df: DataFrame, row: str, elements: str, values: list[str] | None = None, title: bool = True
) -> DataFrame:
    """1 where an element occurs in the row's array and 0 elsewhere, one column per element."""
    pairs = df.select(row, F.explode(elements).alias("_element")).distinct()
    matrix = pairs.groupBy(row).pivot("_element", values).agg(F.count(F.lit(1)))
    matrix = matrix.fillna(0)
    return matrix.withColumn(row, title_words(F.col(row))) if title else matrix


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def count_elements(df: DataFrame, elements: str, out: str = "element") -> DataFrame:
    """Rows per array element; a row counts once for each distinct element."""
    exploded = df.select(F.explode(F.array_distinct(elements)).alias(out))
    return exploded.groupBy(out).agg(F.count(F.lit(1)).alias("n"))


def histograms(df: DataFrame, columns: list[str], bins: int = 30) -> DataFrame:
    """Equal-width histograms: ``column, bin, lower, upper, n``, empty bins included.

    The top edge belongs to the last bin, nulls are left out, and a constant column is widened
    by half on each side. One aggregate finds all ranges, one counts all columns together.
    """
    numbers = df.select(*[to_double(F.col(c)).alias(c) for c in columns])
    ranges = numbers.agg(
        *[F.struct(F.min(c).alias("low"), F.max(c).alias("high")).alias(c) for c in columns]
    )
    ranges = ranges.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"),
                        (F.col(c)["low"] - _half_if_flat(c)).alias("low"),
                        (F.col(c)["high"] + _half_if_flat(c)).alias("high"),
                    )
                    for c in columns
                ]
            )
        )
    ).filter(F.col("low").isNotNull())
    lookup = ranges.agg(
        F.map_from_entries(
            F.collect_list(F.struct("column", F.struct("low", "high").alias("range")))
        ).alias("ranges")
    ).scalar()
    ranged = numbers.withColumn("_ranges", lookup)
    entries = []
    for c in columns:
        span = F.col("_ranges")[c]
        step = F.floor((F.col(c) - span["low"]) / (span["high"] - span["low"]) * bins)
        last = F.when(step >= bins, F.lit(bins - 1)).otherwise(step)
        entries.append(F.struct(F.lit(c).alias("column"), last.cast("bigint").alias("bin")))
    counted = (
        ranged.select(F.inline(F.array(*entries)))
        .filter(F.col("bin").isNotNull())
        .groupBy("column", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    width = (F.col("high") - F.col("low")) / bins
    frame = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)).cast("array<bigint>")))
    return frame.join(counted, ["column", "bin"], "left").select(
        "column",
        "bin",
        (F.col("low") + F.col("bin") * width).alias("lower"),
        (F.col("low") + (F.col("bin") + 1) * width).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def _half_if_flat(c: str) -> Column:
    return F.when(F.col(c)["low"] == F.col(c)["high"], 0.5).otherwise(0.0)


def series(
    df: DataFrame, x: str, y: str, by: str | None = None, x_is_time: bool = False
) -> DataFrame:
    """The two columns behind a line or scatter chart, numeric, in order."""
    left = parse_timestamp(F.col(x)) if x_is_time else to_double(F.col(x))
    keys = [by] if by else []
    return df.select(*keys, left.alias(x), to_double(F.col(y)).alias(y)).orderBy(*keys, x, y)


def element_union(df: DataFrame, elements: str, keys: list[str] | None = None) -> DataFrame:
    """Sorted union of the array column, overall or per group.

    Elements are made distinct before they are gathered, so a group costs as much as its result.
    """
    keys = keys or []
    pairs = df.select(*keys, F.explode(elements).alias("_element")).distinct()
    return pairs.groupBy(*keys).agg(F.array_sort(F.collect_list("_element")).alias(elements))


def distinct_elements(df: DataFrame, element: Column, out: str, keys: list[str] | None = None) -> DataFrame:
    """Distinct non-null elements of an array as rows, with their 0-based ``position`` in order.

    Overall or per group, as ``element_union``, but no task and no row holds a whole union.
    Eager: the numbered rows are stored.
    """
    keys = keys or []
    rows = df.select(*keys, F.explode(element).alias(out)).dropna(subset=[out]).distinct()
    numbered = running_totals(rows, keys, [F.col(out)], {"position": F.lit(1)})
    return numbered.withColumn("position", F.col("position") - 1)
