"""Soil records and gridded moisture into one table of readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlake.functions.identity import grid_field_id
from fieldlake.functions.numeric import to_double
from fieldlake.operators.enrich import (
    annual_moisture,
    expand_years,
    fill_by_year,
    fill_constant,
    fill_moisture,
    join_annual,
)
from fieldlake.operators.mapping import (
    map_database_soil,
    map_local_soil,
    tag_scenario,
    with_row_id,
    with_year,
)
from fieldlake.operators.quality import gate
from fieldlake.schema import DEFAULT_MOISTURE, DEFAULT_TEMPERATURE
from fieldlake.session import materialise

INTEGRATED = [
    "timestamp",
    "field_id",
    "soil_ph",
    "nitrogen",
    "phosphorus",
    "potassium",
    "temperature",
    "q_value",
    "year",
    "moisture",
    "scenario",
]


def merge_datasets(
    soils: DataFrame,
    annual: DataFrame,
    one_row_per_year: bool = False,
    expand: bool | None = None,
) -> DataFrame:
    """Mapped soil records enriched with annual moisture, filled, tagged and gated.

    Records that cover no more than one year are repeated over all moisture years. A missing
    moisture becomes the grid's value, else the record's own, else the mean of its year, else
    30; a missing temperature becomes 20. With ``one_row_per_year`` the records are read twice
    and none takes part in a shuffle.
    """
    if {"lat", "lon"} <= set(soils.columns):
        where = grid_field_id(to_double(F.col("lat")), to_double(F.col("lon")))
        soils = soils.withColumn("field_id", where).drop("lat", "lon")
    elif "field_id" not in soils.columns:
        soils = with_row_id(soils)
    if "soil_moisture" in annual.columns:
        annual = annual.withColumnRenamed("soil_moisture", "moisture")
    if "year" not in annual.columns:
        annual = annual.withColumn("year", F.year("timestamp"))
    if one_row_per_year:
        filled = fill_by_year(with_year(soils), annual, expand, DEFAULT_MOISTURE)
    else:
        dated = expand_years(with_year(soils), annual, expand)
        filled = fill_moisture(join_annual(dated, annual), DEFAULT_MOISTURE)
    filled = fill_constant(filled, "temperature", DEFAULT_TEMPERATURE)
    return gate(tag_scenario(filled)).select(*INTEGRATED)


def integrate(
    raw_soils: DataFrame,
    grid: DataFrame,
    expand: bool | None = None,
    store_mapped: bool = False,
) -> DataFrame:
    """Raw soil records and a long moisture grid, by spatial means per time step.

    The annual means, a row per year, are stored once instead of being recomputed wherever they
    are used. The soil records are read twice, once for their years and moisture only;
    ``store_mapped`` stores them as mapped, which pays off if they come from text files.
    """
    annual = materialise(annual_moisture(grid, "step_mean"), "annual")
    soils = map_database_soil(raw_soils)
    if store_mapped:
        soils = materialise(soils, "soils")
    return merge_datasets(soils, annual, True, expand)


def integrate_local(raw_soils: DataFrame, grid: DataFrame) -> DataFrame:
    """The other pipeline: own times, no expansion, monthly cell means, grid moisture only.

    A record whose temperature column exists but is empty is dropped by the gate.
    """
    soils = with_year(map_local_soil(raw_soils))
    annual = materialise(annual_moisture(grid, "cell_month"), "annual")
    joined = join_annual(soils, annual, one_row_per_year=True)
    # without moisture of its own, the mean of a record's year is the grid's value itself
    own = "moisture" in soils.columns
    filled = fill_moisture(joined) if own else fill_constant(joined, "moisture", DEFAULT_MOISTURE)
    return gate(tag_scenario(filled)).select(*INTEGRATED)
