"""From synthetic readings to a searchable, partitioned table and a forecast."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from fieldlake.operators.embeddings import DIMENSION, embed_text
from fieldlake.operators.forecast import forecast
from fieldlake.operators.rows import top_n
from fieldlake.operators.search import build_index, search_text
from fieldlake.operators.serialise import with_reading_json
from fieldlake.operators.whatif import stress_test
from fieldlake.sinks.writers import load_readings, replace_parquet, write_csv
from fieldlake.sources.generator import generate_readings, without_coherence
from fieldlake.sources.tables import read_parquet


@dataclass
class SensorRun:
    """Paths and results of a run; the results are lazy."""

    readings_path: str
    embeddings_path: str | None = None
    index_path: str | None = None
    matches: DataFrame | None = None
    forecasts: DataFrame | None = None


def embed_readings(
    readings: DataFrame, path: str, dimension: int = DIMENSION, text: str = "content"
) -> str:
    """Readings with their JSON text and its embedding, stored."""
    return replace_parquet(embed_text(with_reading_json(readings, text), text, dimension), path)


def run_sensor_pipeline(
    spark: SparkSession,
    root: str,
    scenario: str = "soil_chemistry",
    samples: int = 200,
    fields: int = 3,
    coherent: bool = True,
    offline: bool = False,
    query: str = "drought stress in corn fields",
    history: DataFrame | None = None,
    dimension: int = DIMENSION,
    cells: int | None = None,
) -> SensorRun:
    """Generate, gate and load readings, embed and index them, search, and forecast.

    Every stage reads what the one before it stored, so a lost executor costs a stage at most.
    ``coherent=False`` is the ablation; ``offline`` stops after a CSV.
    """
    readings = generate_readings(spark, scenario, samples, fields)
    if not coherent:
        readings = without_coherence(readings)
    if offline:
        return SensorRun(write_csv(readings, f"{root}/readings_csv"))
    run = SensorRun(load_readings(readings, f"{root}/readings"))
    stored = read_parquet(spark, run.readings_path)
    run.embeddings_path = embed_readings(stored, f"{root}/embeddings", dimension)
    embedded = read_parquet(spark, run.embeddings_path)
    run.index_path = build_index(embedded, f"{root}/index", cells)
    run.matches = search_text(
        embedded, query, 3, "timestamp", dimension=dimension, index=run.index_path
    )
    if history is not None:
        series = [c for c in history.columns if c not in ("timestamp", "yield")]
        run.forecasts = forecast(history, series)
    return run


def run_stress_test(spark: SparkSession, samples: int = 200, fields: int = 3) -> DataFrame:
    """Baseline against drought for generated readings: ``metric, baseline, drought, delta``."""
    return stress_test(generate_readings(spark, "baseline", samples, fields))


def preview(readings: DataFrame, order: list, n: int = 10) -> DataFrame:
    """The first rows in a stated order."""
    return top_n(readings, order, n)
