"""The application catalogue: what a detected concept may be used for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "name string, description string, domains array<string>, market_potential string"

# The catalogue's entries.
APPLICATIONS: list[tuple[str, str, list[str], str]] = [
    (
        "gravitational_wave_detection",
        "Quantum sensors for gravitational wave detection and astrophysical observation",
        ["research", "astrophysics", "national_labs"],
        "medium",
    ),
    (
        "magnetic_field_sensing",
        "NV-center magnetometry and atomic magnetometers for biomedical and geophysical sensing",
        ["biomedical", "geoscience", "defense"],
        "high",
    ),
    (
        "quantum_clock_synchronization",
        "Optical lattice clocks and quantum timekeeping for navigation and finance",
        ["telecom", "finance", "navigation"],
        "high",
    ),
    (
        "quantum_imaging",
        "Quantum-enhanced imaging and sensing for low-light and high-resolution applications",
        ["medical", "manufacturing", "security"],
        "medium",
    ),
    (
        "environmental_monitoring",
        "Quantum sensors for environmental monitoring and precision agriculture",
        ["agriculture", "environment"],
        "high",
    ),
]


def applications(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(APPLICATIONS, SCHEMA)
