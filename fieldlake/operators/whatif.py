"""What-if scenarios and ablation comparisons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlake.functions.numeric import clip_lower
from fieldlake.operators.quality import clamp_ranges

# Strength of the drought scenario and the metrics compared.
DROUGHT_MOISTURE = 0.5
DROUGHT_WARMING = 4.0
METRICS = {
    "avg_moisture": "moisture",
    "avg_temperature": "temperature",
    "avg_ph": "soil_ph",
}


def apply_drought(
    readings: DataFrame,
    moisture_factor: float = DROUGHT_MOISTURE,
    warming: float = DROUGHT_WARMING,
) -> DataFrame:
    """Drier and warmer readings, within the agronomic ranges."""
    stressed = readings.withColumns(
        {
            "moisture": clip_lower(F.col("moisture") * moisture_factor, 0.0),
            "temperature": F.col("temperature") + warming,
        }
    )
    return clamp_ranges(stressed)


def compare_runs(
    baseline: DataFrame,
    scenario: DataFrame,
    metrics: dict[str, str] = METRICS,
    name: str = "drought",
) -> DataFrame:
    """``metric, baseline, <name>, delta``: means of both runs, one row per metric."""
    columns = list(metrics.values())
    both = baseline.select(F.lit(True).alias("_base"), *columns).unionByName(
        scenario.select(F.lit(False).alias("_base"), *columns)
    )
    sides = {"b": F.col("_base"), "s": ~F.col("_base")}
    means = both.agg(
        *[
            F.avg(F.when(side, F.col(column))).alias(f"{key}_{i}")
            for i, column in enumerate(columns)
            for key, side in sides.items()
        ]
    )
    rows = [
        F.struct(
            F.lit(metric).alias("metric"),
            F.col(f"b_{i}").alias("baseline"),
            F.col(f"s_{i}").alias(name),
            (F.col(f"s_{i}") - F.col(f"b_{i}")).alias("delta"),
        )
        for i, metric in enumerate(metrics)
    ]
    return means.select(F.inline(F.array(*rows)))


def stress_test(readings: DataFrame, **drought: float) -> DataFrame:
    """Baseline against drought for the same readings."""
    return compare_runs(clamp_ranges(readings), apply_drought(readings, **drought))


def compare_ablation(runs: DataFrame, run: str = "run", threshold: float = 0.7) -> DataFrame:
    """Mean score, high scores and the pH and nitrogen ranges of every run."""
    return runs.groupBy(run).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("q_value").alias("avg_q_value"),
        F.count_if(F.col("q_value") > threshold).alias("n_high"),
        F.min("soil_ph").alias("min_ph"),
        F.max("soil_ph").alias("max_ph"),
        F.min("nitrogen").alias("min_nitrogen"),
        F.max("nitrogen").alias("max_nitrogen"),
    )
