"""The quality gate: required columns, null drop, clamp, range mask, quarantine."""

from __future__ import annotations

import functools
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlake.functions.numeric import clamp, coherence_tier, in_range, nan_to_null
from fieldlake.schema import CRITICAL, RANGES, REQUIRED


def check_columns(df: DataFrame, required: list[str] = REQUIRED) -> DataFrame:
    """Fail before any job runs if a required column is absent."""
    missing = [name for name in required if name not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def present(df: DataFrame, names: list[str]) -> dict[str, Column]:
    """Per column, whether it has a value: neither NULL nor NaN."""
    kinds = dict(df.dtypes)

    def known(name: str) -> Column:
        column = F.col(name)
        return (nan_to_null(column) if kinds[name] in ("double", "float") else column).isNotNull()

    return {name: known(name) for name in names}


def drop_incomplete(
    df: DataFrame, critical: list[str] = CRITICAL, drop_invalid: bool = True
) -> DataFrame:
    """Drop rows with a NULL or NaN in a critical column, or fail on the first sign of one."""
    if drop_invalid:
        return df.dropna(subset=critical)
    if df.filter(~_complete(df, critical)).limit(1).count():
        raise ValueError("Nulls found in critical columns")
    return df


def _complete(df: DataFrame, critical: list[str]) -> Column:
    return functools.reduce(Column.__and__, present(df, critical).values())


def keep_incomplete(df: DataFrame, critical: list[str] = CRITICAL) -> DataFrame:
    """The rows that ``drop_incomplete`` drops."""
    return df.filter(~_complete(df, critical))


def clamp_ranges(df: DataFrame, ranges: dict[str, tuple[float, float]] = RANGES) -> DataFrame:
    """Clamp every known column that is present; see ``clamp`` for NULL and NaN."""
    present = {c: clamp(F.col(c), lo, hi) for c, (lo, hi) in ranges.items() if c in df.columns}
    return df.withColumns(present) if present else df


def keep_in_range(
    df: DataFrame,
    ranges: dict[str, tuple[float, float]] = RANGES,
    drop_invalid: bool = True,
) -> DataFrame:
    """Keep rows whose measurements lie in their ranges, or fail if any does not."""
    inside = {
        name: F.coalesce(in_range(F.col(name), low, high), F.lit(False))
        for name, (low, high) in ranges.items()
        if name in df.columns
    }
    if drop_invalid:
        return df.filter(functools.reduce(Column.__and__, inside.values(), F.lit(True)))
    if inside:
        found = df.agg(*[F.bool_or(~good).alias(name) for name, good in inside.items()]).first()
        bad = [name for name in inside if found[name]]
        if bad:
            raise ValueError(f"Out-of-bounds values detected in {', '.join(bad)}")
    return df


def gate(df: DataFrame, drop_invalid: bool = True) -> DataFrame:
    """Columns, completeness and clamp in one narrow stage.

    Clamped values are in range by construction, so the mask of :func:`keep_in_range` could
    drop nothing here and is left out; use it on its own, or :func:`quarantine`, to reject
    out-of-range readings instead of saturating them.
    """
    return clamp_ranges(drop_incomplete(check_columns(df), drop_invalid=drop_invalid))


def with_violations(
    df: DataFrame,
    critical: list[str] = CRITICAL,
    ranges: dict[str, tuple[float, float]] = RANGES,
) -> DataFrame:
    """Add ``violations``: the reasons why a row is not clean, sorted by name."""
    reasons = {f"{name}:missing": ~known for name, known in present(df, critical).items()}
    for name, (low, high) in ranges.items():
        if name in df.columns:
            value = nan_to_null(F.col(name))
            reasons[f"{name}:low"] = value < low
            reasons[f"{name}:high"] = value > high
    flags = [F.when(reasons[key], F.lit(key)) for key in sorted(reasons)]
    return df.withColumn("violations", F.array_compact(F.array(*flags)))


def is_clean(
    df: DataFrame,
    critical: list[str] = CRITICAL,
    ranges: dict[str, tuple[float, float]] = RANGES,
) -> Column:
    """Whether a row is complete and in range; never NULL."""
    bounded = [name for name in ranges if name in df.columns]
    checks = [F.col(c).between(*[F.lit(x) for x in ranges[c]]) for c in bounded]
    checks += present(df, [name for name in critical if name not in bounded]).values()
    return F.coalesce(functools.reduce(Column.__and__, checks), F.lit(False))


def quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clean rows as they are, and rejected rows with their ``violations``."""
    clean = is_clean(check_columns(df))
    return df.filter(clean), with_violations(df.filter(~clean))


def recent(
    df: DataFrame, as_of: datetime | Column, days: int = 7, timestamp: str = "timestamp"
) -> DataFrame:
    """Rows strictly younger than ``days`` before ``as_of``.

    On a table partitioned by ``day`` the partition column is filtered as well, which prunes.
    """
    moment = as_of if isinstance(as_of, Column) else F.lit(as_of)
    cutoff = moment - F.make_dt_interval(F.lit(days))
    out = df.filter(F.col(timestamp) > cutoff)
    return out.filter(F.col("day") >= F.to_date(cutoff)) if "day" in df.columns else out


def count_above(df: DataFrame, column: str = "q_value", threshold: float = 0.7) -> DataFrame:
    """Number of rows strictly above a threshold."""
    return df.agg(F.count_if(F.col(column) > threshold).alias("n"))


def with_tier(df: DataFrame, column: str = "q_value", out: str = "tier") -> DataFrame:
    return df.withColumn(out, coherence_tier(F.col(column)))


def drop_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a value (neither NULL nor NaN) in all the columns, ahead of statistics."""
    return df.dropna(subset=columns)


def keep_category(df: DataFrame, column: str, value: object) -> DataFrame:
    return df.filter(F.col(column) == F.lit(value))
