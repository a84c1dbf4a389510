"""The unified reading schema and the value ranges every reading is held to."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Column names and agronomic ranges shared with existing data files.
RANGES: dict[str, tuple[float, float]] = {
    "soil_ph": (3.5, 9.0),
    "moisture": (0.0, 100.0),
    "nitrogen": (0.0, 100.0),
    "phosphorus": (0.0, 50.0),
    "potassium": (0.0, 100.0),
    "temperature": (-20.0, 60.0),
}

READING = StructType(
    [
        StructField("timestamp", TimestampType()),
        StructField("field_id", StringType()),
        StructField("soil_ph", DoubleType()),
        StructField("nitrogen", DoubleType()),
        StructField("phosphorus", DoubleType()),
        StructField("potassium", DoubleType()),
        StructField("moisture", DoubleType()),
        StructField("temperature", DoubleType()),
        StructField("scenario", StringType()),
        StructField("q_value", DoubleType()),
    ]
)

REQUIRED: list[str] = READING.fieldNames()
# A reading may come without a scenario label, but not without anything else.
CRITICAL: list[str] = [name for name in REQUIRED if name != "scenario"]

SOIL_COLUMNS: list[str] = [
    "timestamp",
    "field_id",
    "soil_ph",
    "nitrogen",
    "phosphorus",
    "potassium",
    "moisture",
    "temperature",
    "q_value",
]

# Fill-ins used where a soil record has no measurement of its own.
DEFAULT_MOISTURE = 30.0
DEFAULT_TEMPERATURE = 20.0
REAL_SCENARIO = "real_world"
SEED = 42
