"""Gridded soil moisture in long form, and per-file raster means."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlake.functions.numeric import to_double
from fieldlake.functions.temporal import parse_timestamp, year_from_name, year_start

_COORDINATES = ("time", "lat", "lon", "x", "y", "latitude", "longitude", "band", "spatial_ref")


def value_column(df: DataFrame, wanted: str = "soil_moisture") -> str:
    """The wanted variable, or else the first column that is no coordinate."""
    if wanted in df.columns:
        return wanted
    others = [name for name in df.columns if name.lower() not in _COORDINATES]
    if not others:
        raise ValueError("the grid has no data variable")
    return others[0]


def moisture_grid(
    df: DataFrame, variable: str = "soil_moisture", time_column: str = "time"
) -> DataFrame:
    """A long grid table as ``time, <spatial columns>, soil_moisture``."""
    if time_column not in df.columns:
        raise KeyError(f"the grid needs a {time_column!r} column")
    name = value_column(df, variable)
    spatial = [c for c in df.columns if c not in (time_column, name)]
    time = F.col(time_column)
    if dict(df.dtypes)[time_column] == "string":
        time = parse_timestamp(time)
    return df.select(
        time.cast("timestamp").alias("time"), *spatial, to_double(F.col(name)).alias("soil_moisture")
    )


def raster_means(
    pixels: DataFrame,
    file_column: str = "file",
    value: str = "value",
    strict_year: bool = False,
) -> DataFrame:
    """Mean of the valid pixels of every raster file, dated at the year in the file name.

    Partial sums are formed before the shuffle, so one huge raster costs no more than many.
    """
    means = pixels.groupBy(file_column).agg(F.avg(to_double(F.col(value))).alias("soil_moisture"))
    year = year_from_name(F.element_at(F.split(file_column, "/"), -1), strict_year)
    return means.select(file_column, year_start(year).alias("time"), "soil_moisture")
