"""Numeric column expressions."""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(column: Column) -> Column:
    return F.nanvl(column, F.lit(None).cast("double"))


def to_double(column: Column) -> Column:
    """Number of a text or numeric column; junk and NaN become NULL, also under ANSI."""
    return nan_to_null(column.try_cast("double"))


def clamp(column: Column, low: float, high: float) -> Column:
    """Force a value into [low, high].

    NULL and NaN saturate to ``high``: ``least`` skips NULL and sorts NaN last. The gate
    drops such rows beforehand, callers of the bare clamp get the saturated value.
    """
    return F.greatest(F.lit(low), F.least(F.lit(high), column))


def clamp_and_round(column: Column, low: float, high: float, digits: int = 3) -> Column:
    return F.round(clamp(column, low, high), digits)


def clip_lower(column: Column, low: float) -> Column:
    """``column`` but not below ``low``; NULL stays NULL."""
    return F.when(column < low, F.lit(low)).otherwise(column)


def in_range(column: Column, low: float, high: float) -> Column:
    return column.between(F.lit(low), F.lit(high))


def level(column: Column, medium_above: float = 0.4, high_above: float = 0.7) -> Column:
    """low / medium / high by strict thresholds."""
    return (
        F.when(column > high_above, "high").when(column > medium_above, "medium").otherwise("low")
    )


def coherence_tier(q_value: Column, low: float = 0.3, high: float = 0.7) -> Column:
    """Tier of a q_value; a value on a bound belongs to the middle tier."""
    return (
        F.when(q_value < low, "low")
        .when(q_value <= high, "medium")
        .when(q_value > high, "high")
    )


def dot(left: Column, right: Column) -> Column:
    """Dot product of two numeric arrays in double precision."""
    products = F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, item: total + item)


def hex_to_long(digits: Column) -> Column:
    """Integer of up to 15 hexadecimal digits."""
    return F.conv(digits, 16, 10).cast("long")


def binary_to_long(bits: Column) -> Column:
    """Integer of a string of binary digits."""
    return F.conv(bits, 2, 10).cast("long")


def row_mean(columns: list[Column]) -> Column:
    """Mean over the non-null columns of a row; NULL when all of them are null."""
    numbers = [to_double(c) for c in columns]
    total = functools.reduce(Column.__add__, [F.coalesce(n, F.lit(0.0)) for n in numbers])
    present = functools.reduce(Column.__add__, [n.isNotNull().cast("int") for n in numbers])
    return F.try_divide(total, present)
