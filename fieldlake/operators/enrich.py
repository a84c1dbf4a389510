"""Year-level enrichment: moisture resampling, year expansion, joins and fills.

Frames keyed by ``year`` come from ``year(timestamp)`` and hold one row per calendar year, a few
thousand at the very most. That is the bound behind every broadcast in this module.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlake.functions.numeric import to_double
from fieldlake.functions.temporal import year_start
from fieldlake.schema import DEFAULT_MOISTURE, DEFAULT_TEMPERATURE
from fieldlake.session import materialise

# Months per period.
_STEP = {"month": 1, "year": 12}


def fill_periods(
    df: DataFrame, period: str, every: str, by: list[str] | None = None
) -> DataFrame:
    """Insert the missing months or years of every series, with NULL measurements.

    ``period`` is a date column with at most one row per series and period. Series run over the
    whole span of the table. Each row is stretched up to its successor, so the measurements are
    read once; with several series the two ends of the span take a second look at ``period``.
    Without ``by`` there is one series: one row per month or year, small enough for one task.
    """
    by = by or []
    months = _STEP[every]
    window = Window.partitionBy(*by).orderBy(period)
    spread = df.withColumn("_next", F.lead(period).over(window))
    start, last = F.col(period), F.col(period)
    if by:
        ends = df.agg(F.min(period).alias("first"), F.max(period).alias("last"))
        ends = ends.select(F.struct("first", "last").alias("ends")).scalar()
        spread = spread.withColumns({"_ends": ends, "_previous": F.lag(period).over(window)})
        start = F.when(F.col("_previous").isNull(), F.col("_ends.first")).otherwise(start)
        last = F.col("_ends.last")
    stop = F.coalesce(F.add_months("_next", -months), last)
    step = F.make_ym_interval(F.lit(0), F.lit(months))
    spread = spread.withColumn("_period", F.explode(F.sequence(start, stop, step)))
    values = [c for c in df.columns if c not in (period, *by)]
    return spread.select(
        *by,
        F.col("_period").alias(period),
        *[F.when(F.col("_period") == F.col(period), F.col(c)).alias(c) for c in values],
    )


def resample_mean(
    df: DataFrame,
    every: str,
    by: list[str] | None = None,
    time: str = "time",
    value: str = "soil_moisture",
    dense: bool = True,
    label_end: bool = False,
) -> DataFrame:
    """Mean per calendar month or year, optionally per cell, with empty periods as NULL.

    ``period`` is the first day, or with ``label_end`` the last day of the month or year.
    """
    by = by or []
    keyed = df.withColumn("period", F.trunc(time, every))
    out = keyed.groupBy(*by, "period").agg(F.avg(to_double(F.col(value))).alias(value))
    out = out.filter(F.col("period").isNotNull())
    if dense:
        out = fill_periods(out, "period", every, by)
    if label_end:
        end = F.last_day(F.add_months("period", _STEP[every] - 1))
        out = out.withColumn("period", end)
    return out


def annual_moisture(
    grid: DataFrame, method: str = "step_mean", dense: bool = True
) -> DataFrame:
    """``year, moisture`` from a long grid, one row per year.

    ``step_mean`` averages over space at each time step and then over the steps of a year;
    ``cell_month`` averages each cell per month and then all cell-months of a year. The two
    differ as soon as cells are missing. Both are two-level aggregations whose first level
    combines on the map side.
    """
    if method == "step_mean":
        steps = grid.groupBy("time").agg(F.avg("soil_moisture").alias("soil_moisture"))
        annual = resample_mean(steps, "year", dense=dense)
        return annual.select(F.year("period").alias("year"), F.col("soil_moisture").alias("moisture"))
    if method == "cell_month":
        cells = [c for c in grid.columns if c not in ("time", "soil_moisture")]
        monthly = resample_mean(grid, "month", cells, dense=False)
        return (
            monthly.groupBy(F.year("period").alias("year"))
            .agg(F.avg("soil_moisture").alias("moisture"))
            .select("year", "moisture")
        )
    raise ValueError(f"unknown method {method!r}")


def expand_years(soils: DataFrame, annual: DataFrame, expand: bool | None = None) -> DataFrame:
    """Repeat soil rows for every year of ``annual``, dated at the start of the year.

    Done when the soil rows cover one year or none (``expand=None`` looks), or as told. The
    years travel as one array and are exploded in place: no join, no shuffle. Scores keep the
    value they had before.
    """
    if expand is False:
        return soils
    years = annual.agg(F.array_sort(F.collect_set("year")).alias("years")).scalar()
    frame = soils.withColumn("_years", years)
    if expand is None:
        span = soils.agg((F.count_if(F.col("year").isNotNull()) == 0).alias("none"),
                         (F.min("year") == F.max("year")).alias("one"))
        single = span.select((F.col("none") | F.col("one")).alias("single")).scalar()
        frame = frame.withColumn("_single", single)
    else:
        frame = frame.withColumn("_single", F.lit(True))
    apply = F.col("_single") & (F.size("_years") > 0)
    frame = frame.withColumn("_apply", apply).withColumn(
        "_year", F.explode_outer(F.when(F.col("_apply"), F.col("_years")).otherwise(F.array("year")))
    )
    return frame.withColumns(
        {
            "timestamp": F.when(F.col("_apply"), year_start(F.col("_year"))).otherwise(
                F.col("timestamp")
            ),
            "year": F.col("_year"),
        }
    ).drop("_years", "_single", "_apply", "_year")


def join_annual(
    soils: DataFrame, annual: DataFrame, one_row_per_year: bool = False
) -> DataFrame:
    """Left join on the year; the grid's moisture goes first, the row's own second.

    Several values for a year multiply the soil rows, as the join of distinct (year, moisture)
    pairs does. With ``one_row_per_year`` (the output of :func:`annual_moisture`) the build side
    is bounded and broadcast; otherwise the join is left to AQE, which picks a broadcast from
    the measured size or splits skewed years.
    """
    pairs = annual.select("year", F.col("moisture").alias("_grid_moisture"))
    build = F.broadcast(pairs) if one_row_per_year else pairs.dropDuplicates()
    joined = soils.join(build, "year", "left")
    own = F.col("moisture") if "moisture" in soils.columns else F.lit(None).cast("double")
    return joined.withColumn("moisture", F.coalesce("_grid_moisture", own)).drop("_grid_moisture")


def with_year_mean(df: DataFrame, column: str, out: str, year: str = "year") -> DataFrame:
    """The mean of a row's year on every row; NULL where the year is unknown.

    Aggregate and broadcast instead of a window: one year may hold most rows, and a window
    would put them into one task.
    """
    means = df.filter(F.col(year).isNotNull()).groupBy(year).agg(F.avg(column).alias(out))
    return df.join(F.broadcast(means), year, "left")


def fill_moisture(df: DataFrame, default: float = DEFAULT_MOISTURE) -> DataFrame:
    """A missing moisture becomes the mean of its year, and failing that the default."""
    filled = with_year_mean(df, "moisture", "_year_mean")
    value = F.coalesce("moisture", "_year_mean", F.lit(default))
    return filled.withColumn("moisture", value).drop("_year_mean")


def fill_by_year(
    soils: DataFrame, annual: DataFrame, expand: bool | None = None, default: float = DEFAULT_MOISTURE
) -> DataFrame:
    """Soil rows expanded over the years, joined with ``annual`` and filled, from sums per year.

    The same as :func:`expand_years`, :func:`join_annual` and :func:`fill_moisture` one after
    another, for an ``annual`` of one row per year. The count and the sum of the rows' own
    moisture per year tell whether they cover a single year, and what the mean of a year is
    after the join: the grid's value where there is one, else the mean of the rows' own. So the
    rows are read twice, and only sums are shuffled. Eager up to the sums, as few as years.
    """
    own = F.col("moisture") if "moisture" in soils.columns else F.lit(None).cast("double")
    kept = soils.select("year", own.alias("own")).groupBy("year")
    sums = materialise(kept.agg(F.sum("own").alias("sum"), F.count("own").alias("n")), "year-sums")
    grid = annual.filter("year IS NOT NULL").select(F.col("year").alias("_of"), F.col("moisture").alias("_grid"))
    if expand is None:
        expand = sums.filter("year IS NOT NULL").count() <= 1
    if expand and not grid.isEmpty():
        years = grid.agg(F.array_sort(F.collect_set("_of")).alias("years")).scalar()
        rows = soils.withColumn("_years", years).withColumn("_year", F.explode("_years"))
        rows = rows.withColumns({"timestamp": year_start(F.col("_year")), "year": F.col("_year")}).drop("_years", "_year")
        mean = sums.agg(F.try_divide(F.sum("sum"), F.sum("n"))).scalar()
        fills = grid.withColumn("_mean", mean)
    else:
        rows = soils
        means = sums.filter("year IS NOT NULL").select("year", F.try_divide("sum", "n").alias("_mean"))
        fills = means.join(grid, F.col("year") == F.col("_of"), "left").select(F.col("year").alias("_of"), "_grid", "_mean")
    joined = rows.join(F.broadcast(fills), F.col("year") == F.col("_of"), "left")
    filled = F.coalesce("_grid", own, "_mean", F.lit(default))
    return joined.withColumn("moisture", filled).drop("_of", "_grid", "_mean")


def fill_constant(df: DataFrame, column: str, value: float) -> DataFrame:
    """Numbers of a column with a constant for what is missing or unreadable."""
    own = to_double(F.col(column)) if column in df.columns else F.lit(None).cast("double")
    return df.withColumn(column, F.coalesce(own, F.lit(value)))


def fill_temperature_default(df: DataFrame) -> DataFrame:
    return fill_constant(df, "temperature", DEFAULT_TEMPERATURE)


def fill_temperature(
    readings: DataFrame, weather: DataFrame | None = None, precision: int = 3
) -> DataFrame:
    """Missing temperatures from a weather table ``lat, lon, date, temperature``.

    Matched on rounded coordinates and the day, with one mean per key so that no reading is
    repeated. Without a table nothing is filled.
    """
    if weather is None:
        return readings

    def keys(lat: str, lon: str, date: Column) -> list[Column]:
        return [
            F.round(lat, precision).alias("_lat"),
            F.round(lon, precision).alias("_lon"),
            date.alias("_date"),
        ]

    means = weather.groupBy(*keys("lat", "lon", F.to_date("date"))).agg(
        F.avg("temperature").alias("_weather")
    )
    keyed = readings.select("*", *keys("lat", "lon", F.to_date("timestamp")))
    return (
        keyed.join(means, ["_lat", "_lon", "_date"], "left")
        .withColumn("temperature", F.coalesce("temperature", "_weather"))
        .drop("_lat", "_lon", "_date", "_weather")
    )
