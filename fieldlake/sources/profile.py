"""A first look at a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile(df: DataFrame) -> DataFrame:
    """One row per column: name, type, rows, nulls, smallest and largest value as text.

    Maps and variants have no order, so their smallest and largest values are NULL. A single
    scan; the wide one-row aggregate is turned into rows afterwards.
    """
    measures = [F.count(F.lit(1)).alias("_rows")]
    for position, field in enumerate(df.schema.fields):
        column = F.col(f"`{field.name}`")
        if field.dataType.typeName() in ("double", "float"):
            column = column + F.lit(0.0)  # -0.0 reads as 0.0
        ordered = F.lit(None) if field.dataType.typeName() in ("map", "variant") else column
        measures += [
            F.count(column).alias(f"_present_{position}"),
            F.min(ordered).cast("string").alias(f"_min_{position}"),
            F.max(ordered).cast("string").alias(f"_max_{position}"),
        ]
    rows = [
        F.struct(
            F.lit(field.name).alias("column"),
            F.lit(field.dataType.simpleString()).alias("type"),
            F.col("_rows").alias("rows"),
            (F.col("_rows") - F.col(f"_present_{position}")).alias("nulls"),
            F.col(f"_min_{position}").alias("min"),
            F.col(f"_max_{position}").alias("max"),
        )
        for position, field in enumerate(df.schema.fields)
    ]
    return df.agg(*measures).select(F.inline(F.array(*rows)))
