"""Mapping of loosely named soil columns onto the unified schema.

Columns are resolved by name on the driver, per table; the values never leave the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlake.functions.identity import deterministic_score, grid_field_id
from fieldlake.functions.numeric import row_mean, to_double
from fieldlake.functions.temporal import parse_timestamp, second_text, start_of_year
from fieldlake.operators.ranges import dense_ids
from fieldlake.schema import DEFAULT_TEMPERATURE, REAL_SCENARIO, SOIL_COLUMNS

# Column names found in soil tables, in order of preference.
LOCAL_TIME_COLUMNS = [
    "timestamp",
    "SamplingYear",
    "Year",
    "YEAR",
    "YearPublication",
    "date",
    "Sampling_Date",
]
DATABASE_TIME_COLUMNS = [
    "SamplingYear",
    "YearPublication",
    "Year",
    "YEAR",
    "Sampling_Date",
    "date",
    "timestamp",
]
LATE_TIME_COLUMNS = ["collection_date", "sample_date", "datetime"]
MEASUREMENT_NAMES = {
    "soil_ph": ["SoilpH"],
    "nitrogen": ["N", "N_total", "Nitrogen"],
    "phosphorus": ["P", "P_total", "Phosphorus"],
    "potassium": ["K", "K_total", "Potassium"],
}
MEASUREMENT_PREFIXES = {"soil_ph": "PH", "nitrogen": "N", "phosphorus": "P", "potassium": "K"}


def first_present(df: DataFrame, candidates: list[str]) -> str | None:
    """The first candidate that is a column of the table."""
    return next((name for name in candidates if name in df.columns), None)


def rename_pairs(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename the columns, but only if all of them are present."""
    return df.withColumnsRenamed(names) if set(names) <= set(df.columns) else df


def with_timestamp(df: DataFrame, candidates: list[str], yearly: bool = False) -> DataFrame:
    """``timestamp`` from the first candidate column; NULL if there is none."""
    source = first_present(df, candidates)
    if source is None:
        return df.withColumn("timestamp", F.lit(None).cast("timestamp"))
    parsed = parse_timestamp(F.col(f"`{source}`"))
    return df.withColumn("timestamp", start_of_year(parsed) if yearly else parsed)


def with_year(df: DataFrame, timestamp: str = "timestamp", out: str = "year") -> DataFrame:
    return df.withColumn(out, F.year(timestamp))


def with_named_measurements(
    df: DataFrame, names: dict[str, list[str]] = MEASUREMENT_NAMES
) -> DataFrame:
    """Targets that are not columns yet, from the first of their alternative names."""
    found = {}
    for target, choices in names.items():
        source = first_present(df, choices)
        if target not in df.columns and source is not None:
            found[target] = to_double(F.col(f"`{source}`"))
    return df.withColumns(found) if found else df


def prefix_columns(df: DataFrame, prefix: str) -> list[str]:
    """Columns named ``prefix`` or ``prefix_*`` in any case. ``P`` does not find ``PH_1``."""
    wanted = prefix.upper()
    return [c for c in df.columns if c.upper() == wanted or c.upper().startswith(f"{wanted}_")]


def with_prefix_means(
    df: DataFrame, prefixes: dict[str, str] = MEASUREMENT_PREFIXES
) -> DataFrame:
    """Targets that are not columns yet, as row means over the columns with their prefix."""
    found = {}
    for target, prefix in prefixes.items():
        columns = prefix_columns(df, prefix)
        if target not in df.columns and columns:
            found[target] = row_mean([F.col(f"`{c}`") for c in columns])
    return df.withColumns(found) if found else df


def with_missing_columns(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Add absent columns with a default; present ones keep their nulls."""
    absent = {name: value for name, value in defaults.items() if name not in df.columns}
    return df.withColumns(absent) if absent else df


def with_row_id(df: DataFrame, out: str = "field_id") -> DataFrame:
    """A dense id per row that depends on the rows only. Eager: the numbered rows are stored."""
    return dense_ids(df, "_row").withColumn(out, F.col("_row").cast("string")).drop("_row")


def with_field_id(df: DataFrame, replace: bool = False) -> DataFrame:
    """``field_id`` from the coordinates if there are any, from the row otherwise."""
    if "field_id" in df.columns and not replace:
        return df
    if {"lat", "lon"} <= set(df.columns):
        return df.withColumn("field_id", grid_field_id(to_double(F.col("lat")), to_double(F.col("lon"))))
    return df if "field_id" in df.columns else with_row_id(df)


def with_score(df: DataFrame, timestamp: Column | None = None) -> DataFrame:
    """``q_value``: reproducible score of the field id and the time."""
    time = second_text(F.col("timestamp")) if timestamp is None else timestamp
    return df.withColumn("q_value", deterministic_score(F.col("field_id"), time))


def tag_scenario(df: DataFrame, scenario: str = REAL_SCENARIO) -> DataFrame:
    return df.withColumn("scenario", F.lit(scenario))


def coerce_numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    found = {c: to_double(F.col(c)) for c in columns if c in df.columns}
    return df.withColumns(found) if found else df


def map_database_soil(raw: DataFrame) -> DataFrame:
    """Soil records in the unified columns: yearly time, prefix means, grid field id, score."""
    df = rename_pairs(raw, {"Latitude": "lat", "Longitude": "lon"})
    late = first_present(df, DATABASE_TIME_COLUMNS) is None
    df = with_timestamp(df, LATE_TIME_COLUMNS if late else DATABASE_TIME_COLUMNS, yearly=not late)
    df = with_named_measurements(df, {"soil_ph": MEASUREMENT_NAMES["soil_ph"]})
    df = with_field_id(with_prefix_means(df))
    numbers = ["soil_ph", "nitrogen", "phosphorus", "potassium", "moisture", "temperature"]
    df = with_missing_columns(coerce_numbers(df, numbers), {n: _null_double() for n in numbers})
    return with_score(df).select(*SOIL_COLUMNS)


def map_local_soil(raw: DataFrame) -> DataFrame:
    """Soil records in the unified columns without moisture: own time, fixed names, 20 degrees.

    Unlike :func:`map_database_soil` this prefers an exact time, takes measurements by name
    only, and keeps an existing score.
    """
    df = with_timestamp(raw, LOCAL_TIME_COLUMNS)
    df = with_field_id(with_named_measurements(df))
    numbers = ["soil_ph", "nitrogen", "phosphorus", "potassium"]
    df = with_missing_columns(df, {n: _null_double() for n in numbers})
    df = with_missing_columns(df, {"temperature": F.lit(DEFAULT_TEMPERATURE)})
    df = coerce_numbers(df, [*numbers, "temperature", "q_value"])
    df = df if "q_value" in df.columns else with_score(df)
    return df.select(*[c for c in SOIL_COLUMNS if c != "moisture"])


def _null_double() -> Column:
    return F.lit(None).cast("double")
