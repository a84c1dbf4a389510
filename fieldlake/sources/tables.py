"""Columnar files and catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from fieldlake.functions.numeric import nan_to_null
from fieldlake.session import use_utc


def read_parquet(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """Parquet scan; projections and filters reach the files."""
    return use_utc(spark).read.option("mergeSchema", merge_schema).parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Table of the session catalog (``catalog.schema.table``)."""
    return use_utc(spark).table(name)


def normalise(df: DataFrame) -> DataFrame:
    """Make scan types uniform: zone-less timestamps become timestamps, NaN becomes NULL.

    Done once at the source, so no later mean, minimum or null check meets a NaN.
    """
    changes = {}
    for field in df.schema.fields:
        if field.dataType.typeName() == "timestamp_ntz":
            changes[field.name] = F.col(f"`{field.name}`").cast("timestamp")
        elif isinstance(field.dataType, (DoubleType, FloatType)):
            changes[field.name] = nan_to_null(F.col(f"`{field.name}`")).cast(field.dataType)
    return df.withColumns(changes) if changes else df
