from datetime import datetime, timezone

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from fieldlake.operators import stats
from fieldlake.sinks import writers
from fieldlake.sources.generator import generate_readings

END = datetime(2024, 5, 3, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def readings(spark):
    return generate_readings(spark, samples=300, fields=3, end=END)


def test_csv_round_trip(spark, readings, tmp_path):
    path = writers.write_csv(readings, str(tmp_path / "csv"))
    back = spark.read.schema(readings.schema).option("header", True).csv(path)
    assert readings.exceptAll(back).count() == 0 and back.count() == 300


def test_load_is_partitioned_by_day_and_pruned(spark, readings, tmp_path, plan_of):
    path = writers.load_readings(readings, str(tmp_path / "t"))
    back = spark.read.parquet(path)
    assert readings.exceptAll(back.drop("day")).count() == 0
    day = back.filter(F.col("day") == F.lit("2024-05-01").cast("date"))
    assert day.count() == 96
    assert "PartitionFilters: [isnotnull(day" in plan_of(day)


def test_load_gates_first(spark, readings, tmp_path):
    broken = readings.withColumn("moisture", F.when(F.col("field_id") != "field_1", F.lit(500.0)))
    back = spark.read.parquet(writers.load_readings(broken, str(tmp_path / "t")))
    assert back.count() == 200
    assert [r[0] for r in back.select("moisture").distinct().collect()] == [100.0]


def test_load_modes(spark, readings, tmp_path):
    path = str(tmp_path / "t")
    writers.load_readings(readings, path)
    writers.load_readings(readings, path, if_exists="append")
    assert spark.read.parquet(path).count() == 600
    with pytest.raises(AnalysisException):
        writers.load_readings(readings, path, if_exists="error")
    last = readings.filter(F.col("timestamp") >= "2024-05-02")
    writers.load_readings(last, path, replace_days_only=True)
    assert spark.read.parquet(path).count() == 600 - last.count()
    writers.load_readings(last, path)
    assert spark.read.parquet(path).count() == last.count()


def test_catalog_tables(spark, readings):
    writers.load_readings_table(readings, "loaded_readings", buckets=4)
    assert spark.table("loaded_readings").count() == 300
    writers.replace_table(spark.table("loaded_readings").groupBy("field_id").count(), "per_field")
    assert {r["count"] for r in spark.table("per_field").collect()} == {100}


def test_fallback_is_opt_in(spark, readings, tmp_path):
    blocked = tmp_path / "file"
    blocked.write_text("in the way")
    bad = str(blocked / "below")
    with pytest.raises(Exception):
        writers.load_or_csv(readings, bad)
    path = writers.load_or_csv(readings.drop("moisture"), str(tmp_path / "x"), str(tmp_path / "csv"))
    assert path.endswith("csv") and spark.read.option("header", True).csv(path).count() == 300


def test_model_summary(spark, readings, tmp_path):
    fit = stats.linear_fit(readings, "q_value", "nitrogen")
    path = writers.write_model_summary(stats.model_summary(fit, readings), str(tmp_path / "m"))
    row = spark.read.json(path).first()
    assert row["status"] == "fitted" and row["n"] == 300
    none = stats.model_summary(stats.fit_yield(readings), readings).first()
    assert none["status"] == "target not found" and none["coef"] is None


def test_a_replacement_that_fails_leaves_the_old_table(spark):
    writers.replace_table(spark.range(10), "replaced")
    broken = spark.range(100).select(F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("x"))).cast("long").alias("id"))
    with pytest.raises(Exception, match="x"):
        writers.replace_table(broken, "replaced")
    assert spark.table("replaced").count() == 10
    reader = spark.table("replaced")
    writers.replace_table(spark.table("replaced").select("id", (F.col("id") * 2).alias("twice")), "replaced")
    assert spark.table("replaced").agg(F.sum("twice")).first()[0] == 90
    assert reader.count() == 10  # what has begun goes on with the rows it found
    writers.replace_table(spark.range(3), "replaced")
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("replaced")] == ["replaced"]
    assert spark.table("replaced").count() == 3


def test_a_bucketed_replacement_keeps_its_buckets(spark, readings, plan_of):
    for scale in (1.0, 2.0):
        changed = readings.withColumn("nitrogen", F.col("nitrogen") * scale)
        writers.load_readings_table(changed, "bucketed_readings", buckets=4)
    with pytest.raises(Exception):
        writers.load_readings_table(readings.drop("moisture"), "bucketed_readings", buckets=4)
    found = spark.table("bucketed_readings")
    assert found.count() == 300
    assert plan_of(found.groupBy("field_id").count()).count("Exchange") == 0
    day = found.filter(F.col("day") == F.lit("2024-05-01").cast("date"))
    assert day.count() == 96 and "PartitionFilters: [isnotnull(day" in plan_of(day)
