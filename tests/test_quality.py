from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fieldlake.operators import quality
from fieldlake.schema import RANGES, READING, REQUIRED

NAN = float("nan")
T = datetime(2024, 1, 1)
ROWS = [
    (T, "a", 6.5, 10.0, 5.0, 8.0, 30.0, 20.0, "s", 0.5),
    (T, "b", 20.0, -1.0, 60.0, 8.0, 30.0, 90.0, None, 0.5),
    (T, "c", None, 10.0, 5.0, 8.0, 30.0, 20.0, "s", 0.5),
    (T, "d", NAN, 10.0, 5.0, 8.0, 30.0, 20.0, "s", 0.5),
    (None, "e", 6.5, 10.0, 5.0, 8.0, 30.0, 20.0, "s", NAN),
]


@pytest.fixture(scope="module")
def readings(spark):
    return spark.createDataFrame(ROWS, READING)


def test_missing_columns_are_all_named(readings):
    with pytest.raises(ValueError, match="moisture.*q_value"):
        quality.gate(readings.drop("moisture", "q_value"))


def test_gate_drops_incomplete_rows_and_clamps(readings):
    rows = {r["field_id"]: r for r in quality.gate(readings).collect()}
    assert set(rows) == {"a", "b"}  # a missing scenario is no reason to drop
    b = rows["b"]
    assert (b["soil_ph"], b["nitrogen"], b["phosphorus"], b["temperature"]) == (9.0, 0.0, 50.0, 60.0)


def test_gate_can_fail_instead(readings):
    with pytest.raises(ValueError, match="Nulls"):
        quality.gate(readings, drop_invalid=False)
    complete = readings.filter(F.col("field_id").isin("a", "b"))
    assert quality.gate(complete, drop_invalid=False).count() == 2


def test_range_mask_after_clamp_drops_nothing(readings):
    gated = quality.gate(readings)
    assert quality.keep_in_range(gated).count() == gated.count()


def test_range_mask_alone(readings):
    assert [r["field_id"] for r in quality.keep_in_range(readings).collect()] == ["a", "e"]
    with pytest.raises(ValueError, match="Out-of-bounds"):
        quality.keep_in_range(readings, drop_invalid=False)


def test_clamp_ignores_absent_columns(readings):
    assert quality.clamp_ranges(readings.select("field_id", "soil_ph")).columns == [
        "field_id",
        "soil_ph",
    ]
    saturated = quality.clamp_ranges(readings).filter("field_id in ('c', 'd')").collect()
    assert [r["soil_ph"] for r in saturated] == [9.0, 9.0]


def test_quarantine_splits_without_loss(readings):
    clean, rejected = quality.quarantine(readings)
    found = {r["field_id"]: r["violations"] for r in rejected.collect()}
    assert [r["field_id"] for r in clean.collect()] == ["a"]
    assert clean.columns == REQUIRED
    assert found == {
        "b": ["nitrogen:low", "phosphorus:high", "soil_ph:high", "temperature:high"],
        "c": ["soil_ph:missing"],
        "d": ["soil_ph:missing"],
        "e": ["q_value:missing", "timestamp:missing"],
    }


def test_recent_is_strict(spark):
    rows = [(datetime(2024, 1, 1),), (datetime(2024, 1, 1, 0, 0, 1),), (datetime(2024, 1, 8),)]
    df = spark.createDataFrame(rows, "timestamp timestamp")
    assert quality.recent(df, datetime(2024, 1, 8)).count() == 2


def test_tiers_and_counts(readings):
    assert quality.count_above(readings, "q_value", 0.4).first()["n"] >= 4
    assert {r["tier"] for r in quality.with_tier(readings.limit(1)).collect()} == {"medium"}


def test_gate_is_one_narrow_stage_without_python(readings, plan_of):
    plan = plan_of(quality.gate(readings))
    assert "Exchange" not in plan and "EvalPython" not in plan and "InPandas" not in plan
    assert len(RANGES) == 6
