from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from fieldlake.operators.quality import gate
from fieldlake.sources.generator import generate_readings
from fieldlake.streaming.gate import (
    gated_means,
    read_stream,
    read_windows,
    tumbling_means,
    upsert_windows,
    write_available,
)


def test_stream_of_several_files_equals_the_batch(spark, tmp_path):
    end = datetime(2024, 5, 1, 12, tzinfo=timezone.utc)
    for part in range(3):
        later = end + timedelta(hours=6 * part)
        readings = generate_readings(spark, samples=24, fields=2, end=later)
        broken = readings.withColumn("moisture", F.when(F.minute("timestamp") != 30, F.col("moisture") * 10))
        broken.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = read_stream(spark, str(tmp_path / "in"), files_per_trigger=1)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    write_available(gated_means(stream), out, state).awaitTermination()
    found = spark.read.parquet(out)
    batch = tumbling_means(gate(spark.read.parquet(str(tmp_path / "in"))))
    last = datetime(2024, 5, 2, 0, 0)
    closed = batch.filter(F.col("window_end") <= F.lit(last - timedelta(hours=1)))
    assert found.count() == closed.count() > 30
    assert found.exceptAll(closed).count() == 0
    # Nothing new to do, and nothing is emitted twice.
    again = read_stream(spark, str(tmp_path / "in"), files_per_trigger=1)
    write_available(gated_means(again), out, state).awaitTermination()
    assert spark.read.parquet(out).count() == closed.count()


def rounded(means):
    return sorted((r["window_start"], r["field_id"], r["n"], round(r["moisture"], 9)) for r in means.collect())


@pytest.mark.parametrize("fold_every", [2, 100])
def test_every_window_is_kept_and_late_readings_count(spark, tmp_path, fold_every):
    end = datetime(2024, 5, 1, 12, tzinfo=timezone.utc)
    for part in (4, 3, 0, 2, 1):  # days out of order, over one another
        readings = generate_readings(spark, samples=40, fields=2, end=end + timedelta(hours=6 * part))
        readings.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")

    def drain(state):
        stream = read_stream(spark, source, files_per_trigger=1)
        upsert_windows(stream, out, state, fold_every=fold_every).awaitTermination()

    drain(state)
    expected = rounded(tumbling_means(gate(spark.read.parquet(source))))
    assert rounded(read_windows(spark, out)) == expected and sum(r[2] for r in expected) == 200
    drain(state)  # nothing new
    assert rounded(read_windows(spark, out)) == expected
    generate_readings(spark, samples=8, fields=2, end=end).coalesce(1).write.mode("append").parquet(source)
    drain(state)
    again = rounded(read_windows(spark, out))
    assert again == rounded(tumbling_means(gate(spark.read.parquet(source)))) and sum(r[2] for r in again) == 208
    with pytest.raises(FileNotFoundError):
        read_windows(spark, str(tmp_path / "nothing"))


@pytest.mark.parametrize("fold_every", [1, 16])
def test_a_repeated_batch_replaces_itself(spark, tmp_path, fold_every):
    end = datetime(2024, 5, 1, 12, tzinfo=timezone.utc)
    generate_readings(spark, samples=20, fields=2, end=end).coalesce(1).write.parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    for attempt in range(2):  # a new state: the stream starts over with batch 0
        stream = read_stream(spark, str(tmp_path / "in"))
        upsert_windows(stream, out, str(tmp_path / f"state{attempt}"), fold_every=fold_every).awaitTermination()
    assert read_windows(spark, out).agg(F.sum("n")).first()[0] == 20
    (tmp_path / "out" / "batch=7").mkdir()  # a writer that has not finished
    assert read_windows(spark, out).agg(F.sum("n")).first()[0] == 20
