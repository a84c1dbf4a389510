"""Collects queries and their SQL counterparts by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that must give the same rows."""

    def register(function: Query) -> Query:
        name = function.__name__
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, because sums depend on the order of the rows; -0.0 becomes 0.0."""
    return df.select(
        *[
            (F.round(f"`{name}`", digits) + F.lit(0.0)).alias(name)
            if kind == "double"
            else F.col(f"`{name}`")
            for name, kind in df.dtypes
        ]
    )


def time_text(column: str | Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def joined(column: str | Column) -> Column:
    """Array as text."""
    return F.array_join(column, "|")
