from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from fieldlake.schema import RANGES, READING
from fieldlake.sources.generator import (
    NOISY,
    generate_readings,
    generate_scenarios,
    without_coherence,
)

END = datetime(2024, 5, 1, 12, 7, 30, tzinfo=timezone.utc)


def made(spark, **options):
    return generate_readings(spark, end=END, **options)


def test_schema_count_and_grid(spark):
    df = made(spark, samples=100, fields=3)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in READING]
    rows = df.orderBy("timestamp").collect()
    assert len(rows) == 100
    assert rows[-1]["timestamp"] == datetime(2024, 5, 1, 12, 0)
    steps = {(b["timestamp"] - a["timestamp"]).seconds for a, b in zip(rows, rows[1:])}
    assert steps == {900}


def test_fields_go_round(spark):
    rows = made(spark, samples=15, fields=3).orderBy("timestamp").collect()
    assert {r["field_id"] for r in rows} == {"field_1", "field_2", "field_3"}
    assert [r["field_id"] for r in rows[:4]] == ["field_1", "field_2", "field_3", "field_1"]


@pytest.mark.parametrize("partitions", [4, 13])
def test_partitions_do_not_matter(spark, partitions):
    one = made(spark, samples=500, partitions=1)
    many = made(spark, samples=500, partitions=partitions)
    assert one.exceptAll(many).count() == 0 and many.count() == 500


def test_distribution(spark):
    df = made(spark, samples=50_000)
    stats = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in [*NOISY, "q_value"]],
        *[F.stddev(F.col(c) - F.col("q_value") * NOISY[c][1]).alias(f"s_{c}") for c in NOISY],
        F.max(F.abs(F.col("soil_ph") - (6.5 + 0.6 * (F.col("q_value") - 0.5)))).alias("ph"),
        *[F.bool_and(F.col(c).between(*map(F.lit, RANGES[c]))).alias(f"in_{c}") for c in RANGES],
    ).first()
    for name, (mean, slope, sd) in NOISY.items():
        assert abs(stats[f"m_{name}"] - (mean + slope / 2)) < sd / 25
        assert abs(stats[f"s_{name}"] / sd - 1) < 0.02
        assert stats[f"in_{name}"]
    assert abs(stats["m_q_value"] - 0.5) < 0.001
    assert stats["ph"] < 0.00051 and stats["in_soil_ph"]


def test_scenario_is_only_a_label_unless_salted(spark):
    values = ["timestamp", "nitrogen", "q_value"]
    both = generate_scenarios(spark, ["x", "y"], 50, end=END)
    assert both.count() == 100
    assert both.select(values).distinct().count() == 50
    salted = generate_scenarios(spark, ["x", "y"], 50, end=END, scenario_salt=True)
    assert salted.select(values).distinct().count() == 100


def test_ablation_touches_the_score_only(spark):
    df = made(spark, samples=20)
    ablated = without_coherence(df)
    assert [r["q_value"] for r in ablated.select("q_value").distinct().collect()] == [0.5]
    assert df.drop("q_value").exceptAll(ablated.drop("q_value")).count() == 0


def test_no_shuffle_and_no_python(spark, plan_of):
    plan = plan_of(made(spark, samples=1000))
    assert "Exchange" not in plan and "Python" not in plan
