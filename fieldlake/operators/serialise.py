"""Rows as text: JSON, prompts, recommendations."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlake.functions.temporal import iso_text
from fieldlake.functions.text import fixed_text

# Fields of a serialised reading, and the wording of the prompt.
JSON_FIELDS = [
    "timestamp",
    "field_id",
    "soil_ph",
    "nitrogen",
    "phosphorus",
    "potassium",
    "moisture",
    "temperature",
]
PROMPT_PARTS = [
    ("Soil pH=", "soil_ph"),
    ("; N=", "nitrogen"),
    ("; K=", "potassium"),
    ("; moisture=", "moisture"),
]
INSTRUCTION = (
    "You are an agricultural advisor. "
    "Provide a concise fertilizer and irrigation recommendation."
)


def row_json(df: DataFrame, columns: list[str], digits: int | None = None) -> Column:
    """The columns as a JSON object in the given order, nulls included.

    With ``digits`` numbers are written with that many decimals and times as ISO text, which
    makes the text independent of the engine.
    """
    kinds = dict(df.dtypes)

    def written(name: str) -> Column:
        column = F.col(name)
        if digits is not None and kinds[name] in ("double", "float"):
            column = fixed_text(column, digits)
        elif kinds[name] == "timestamp":
            column = iso_text(column)
        return column.alias(name)

    return F.to_json(F.struct(*[written(c) for c in columns]), {"ignoreNullFields": "false"})


def with_reading_json(readings: DataFrame, out: str = "content") -> DataFrame:
    return readings.withColumn(out, row_json(readings, JSON_FIELDS))


def with_prompt(readings: DataFrame, digits: int | None = None, out: str = "prompt") -> DataFrame:
    """The advisor's input text; NULL if any of its measurements is."""
    parts: list[Column] = []
    for label, name in PROMPT_PARTS:
        value = F.col(name)
        parts += [F.lit(label), value.cast("string") if digits is None else fixed_text(value, digits)]
    return readings.withColumn(out, F.concat(*parts))


def with_recommendation(readings: DataFrame, out: str = "recommendation") -> DataFrame:
    """Advice by rule for acidity, nitrogen, potassium and water, joined by ``; ``."""
    ph, nitrogen = F.col("soil_ph"), F.col("nitrogen")
    potassium, moisture = F.col("potassium"), F.col("moisture")
    rules = [
        F.when(ph < 5.5, "apply lime").when(ph > 7.5, "apply elemental sulphur"),
        F.when(nitrogen < 10, "apply nitrogen").when(nitrogen > 60, "hold back nitrogen"),
        F.when(potassium < 8, "apply potash").when(potassium > 60, "hold back potash"),
        F.when(moisture < 20, "irrigate").when(moisture > 60, "improve drainage"),
    ]
    advice = F.concat_ws("; ", *rules)
    return readings.withColumn(out, F.when(advice == "", "keep current treatment").otherwise(advice))


def with_generated_text(
    readings: DataFrame,
    generator: Callable[[list[str], str], list[str]],
    out: str = "recommendation",
) -> DataFrame:
    """Advice from a model: ``generator`` gets a batch of prompts and the instruction."""

    @F.pandas_udf("string")
    def generate(prompts: pd.Series) -> pd.Series:
        answers = generator(prompts.fillna("").tolist(), INSTRUCTION)
        return pd.Series(answers, index=prompts.index).where(prompts.notna(), None)

    return with_prompt(readings, out="_prompt").withColumn(out, generate("_prompt")).drop("_prompt")
