"""Per-series linear forecasts with a 95 % prediction interval."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlake.operators.rows import top_per_group

# Length of the forecast and of the history behind it.
HORIZON = 14
LOOKBACK = 30
_Z = 1.96


def daily_means(
    df: DataFrame, series: list[str], timestamp: str = "timestamp", target: str = "yield"
) -> DataFrame:
    """One mean per series and day; readings are combined before the shuffle."""
    return (
        df.select(*series, F.to_date(timestamp).alias("day"), F.col(target).alias("_y"))
        .dropna(subset=["day", "_y"])
        .groupBy(*series, "day")
        .agg(F.avg("_y").alias("y"))
    )


def forecast(
    df: DataFrame,
    series: list[str],
    timestamp: str = "timestamp",
    target: str = "yield",
    lookback: int = LOOKBACK,
    horizon: int = HORIZON,
) -> DataFrame:
    """``horizon`` daily values per series from a line through its last ``lookback`` observed days.

    Positions are day offsets, so gaps count. With fewer than three days, or all on one day, the
    value is their mean and the bounds are NULL. Everything after the daily means is per series
    and day: small, and aggregated once.
    """
    days = top_per_group(daily_means(df, series, timestamp, target), series, [F.desc("day")], lookback)
    points = days.withColumn("x", F.unix_date("day").cast("double"))
    fit = points.groupBy(*series).agg(
        F.count("y").alias("n"),
        F.max("day").alias("last_day"),
        F.avg("x").alias("x_mean"),
        F.avg("y").alias("y_mean"),
        F.regr_sxx("y", "x").alias("sxx"),
        F.regr_sxy("y", "x").alias("sxy"),
        F.regr_syy("y", "x").alias("syy"),
    )
    usable = (F.col("n") >= 3) & (F.col("sxx") > 0)
    slope = F.when(usable, F.col("sxy") / F.col("sxx")).otherwise(0.0)
    residual = F.greatest(F.col("syy") - F.col("slope") * F.col("sxy"), F.lit(0.0))
    steps = (
        fit.withColumn("slope", slope)
        .withColumn("error", F.when(usable, F.sqrt(residual / (F.col("n") - 2))))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
        .withColumn("day", F.date_add("last_day", F.col("step")))
        .withColumn("distance", F.unix_date("day") - F.col("x_mean"))
    )
    value = F.col("y_mean") + F.col("slope") * F.col("distance")
    spread = F.sqrt(1 + 1 / F.col("n") + F.col("distance") * F.col("distance") / F.col("sxx"))
    half = F.when(F.col("error").isNotNull(), _Z * F.col("error") * spread)
    return steps.select(
        *series,
        F.col("day").cast("timestamp").alias("forecast_timestamp"),
        value.alias("forecast_value"),
        (value - half).alias("confidence_interval_lower"),
        (value + half).alias("confidence_interval_upper"),
    )


def forecast_summary(forecasts: DataFrame, series: list[str] | None = None) -> DataFrame:
    """Mean value and bounds over the horizon."""
    return forecasts.groupBy(*(series or [])).agg(
        F.avg("forecast_value").alias("forecast_value"),
        F.avg("confidence_interval_lower").alias("confidence_interval_lower"),
        F.avg("confidence_interval_upper").alias("confidence_interval_upper"),
    )
