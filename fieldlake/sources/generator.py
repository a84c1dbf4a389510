"""Reproducible synthetic readings.

Every value is a function of the row's index and 15-minute window, computed from hashes, so the
table is identical for any number of partitions and needs no state, sort or shuffle.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlake.functions.identity import (
    draw_digits,
    mean_of_digits,
    normals,
    round_robin_field,
)
from fieldlake.functions.numeric import clamp_and_round
from fieldlake.functions.temporal import QUARTER_HOUR, floor_window, window_seed
from fieldlake.schema import RANGES, REQUIRED, SEED
from fieldlake.session import use_utc

# Mean at q = 0, slope in q, and standard deviation of each measurement.
NOISY: dict[str, tuple[float, float, float]] = {
    "nitrogen": (10.0, 2.0, 1.5),
    "phosphorus": (5.0, 1.2, 1.0),
    "potassium": (8.0, 1.4, 1.2),
    "moisture": (30.0, 5.0, 5.0),
    "temperature": (17.0, 6.0, 2.5),
}
PH_CENTRE, PH_SLOPE = 6.5, 0.6
QUBITS, SHOTS = 3, 64
SCENARIOS = ["soil_chemistry", "plant_stress", "extreme_weather"]


def time_grid(index: Column, count: Column, end: Column, seconds: int = QUARTER_HOUR) -> Column:
    """Time of row ``index`` out of ``count`` on a regular grid that ends at ``end``, floored."""
    last = F.unix_timestamp(floor_window(end, seconds))
    return F.timestamp_seconds(last - (count - 1 - index) * seconds)


def with_readings(
    df: DataFrame,
    index: Column,
    timestamp: Column,
    fields: int = 5,
    scenario: Column | None = None,
    qubits: int = QUBITS,
    shots: int = SHOTS,
    scenario_salt: bool = False,
) -> DataFrame:
    """Synthetic readings for the rows of ``df``, in the unified schema.

    ``scenario`` is a label only and does not influence the values unless ``scenario_salt``.
    """
    label = F.lit(SCENARIOS[0]) if scenario is None else scenario
    window = window_seed(timestamp)
    salt = [F.lit(":"), label] if scenario_salt else []
    q_seed = F.concat(window.cast("string"), *salt)
    row_seed = F.concat((F.lit(SEED) + window * 1000 + index).cast("string"), *salt)
    hashed = df.select(
        timestamp.alias("timestamp"),
        round_robin_field(index, fields).alias("field_id"),
        label.alias("scenario"),
        draw_digits(q_seed, qubits, shots).alias("_digits"),
        F.sha2(row_seed, 256).alias("_noise"),
    )
    noise = [z.alias(f"z_{name}") for name, z in zip(NOISY, normals(F.col("_noise"), len(NOISY)))]
    drawn = F.struct(mean_of_digits(F.col("_digits"), qubits, shots).alias("q_value"), *noise)
    # A one-element array, unfolded: a filter on the readings cannot be pushed below it, which
    # would repeat the draws for every measurement it looks at.
    base = hashed.select("timestamp", "field_id", "scenario", F.inline_outer(F.array(drawn)))
    q = F.col("q_value")
    measured = {
        "soil_ph": clamp_and_round(F.lit(PH_CENTRE) + (q - 0.5) * PH_SLOPE, *RANGES["soil_ph"])
    }
    for name, (mean, slope, sd) in NOISY.items():
        value = F.lit(mean) + q * slope + F.col(f"z_{name}") * sd
        # Temperature is left unclamped here; the gate bounds it.
        measured[name] = (
            F.round(value, 3) if name == "temperature" else clamp_and_round(value, *RANGES[name])
        )
    return base.withColumns(measured).select(*REQUIRED)


def generate_readings(
    spark: SparkSession,
    scenario: str = SCENARIOS[0],
    samples: int = 500,
    fields: int = 5,
    end: datetime | None = None,
    partitions: int | None = None,
    qubits: int = QUBITS,
    shots: int = SHOTS,
    scenario_salt: bool = False,
) -> DataFrame:
    """``samples`` readings at 15-minute steps up to ``end`` (default: now), oldest first."""
    return generate_scenarios(
        spark, [scenario], samples, fields, end, partitions, qubits, shots, scenario_salt
    )


def generate_scenarios(
    spark: SparkSession,
    scenarios: list[str],
    samples: int = 500,
    fields: int = 5,
    end: datetime | None = None,
    partitions: int | None = None,
    qubits: int = QUBITS,
    shots: int = SHOTS,
    scenario_salt: bool = False,
) -> DataFrame:
    """The same time grid once per scenario label, as one range of ids."""
    use_utc(spark)
    moment = (end or datetime.now(timezone.utc)).timestamp()
    ids = spark.range(0, samples * len(scenarios), 1, partitions)
    index = F.col("id") % samples
    labels = F.array(*[F.lit(s) for s in scenarios])
    timestamp = time_grid(index, F.lit(samples), F.timestamp_seconds(F.lit(int(moment))))
    return with_readings(
        ids,
        index,
        timestamp,
        fields,
        F.element_at(labels, (F.floor(F.col("id") / samples) + 1).cast("int")),
        qubits,
        shots,
        scenario_salt,
    )


def without_coherence(readings: DataFrame, neutral: float = 0.5) -> DataFrame:
    """Ablation: a neutral q_value. The measurements keep the effect they were drawn with."""
    return readings.withColumn("q_value", F.lit(neutral))
