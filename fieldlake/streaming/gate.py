"""The quality gate over a stream of readings, with tumbling means per field."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fieldlake.operators.quality import gate
from fieldlake.schema import RANGES, READING
from fieldlake.session import use_utc

WINDOW = "15 minutes"
DELAY = "1 hour"


def read_stream(
    spark: SparkSession, path: str, schema=READING, glob: str | None = None,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Parquet files of a folder as a stream."""
    reader = use_utc(spark).readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def tumbling_means(
    readings: DataFrame,
    window: str = WINDOW,
    keys: tuple[str, ...] = ("field_id",),
    columns: tuple[str, ...] = tuple(RANGES),
) -> DataFrame:
    """Means per window and key; the same for a batch and for a stream."""
    grouped = readings.groupBy(F.window("timestamp", window).alias("_window"), *keys)
    means = grouped.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in columns])
    return means.select(
        F.col("_window.start").alias("window_start"),
        F.col("_window.end").alias("window_end"),
        *keys,
        "n",
        *columns,
    )


def gated_means(readings: DataFrame, window: str = WINDOW, delay: str = DELAY) -> DataFrame:
    """Gated readings as tumbling means; a window is emitted once the watermark has passed it.

    State holds one partial mean per field for each window younger than ``delay``.
    """
    return tumbling_means(gate(readings).withWatermark("timestamp", delay), window)


def write_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what is there, append the closed windows to Parquet, and stop.

    The checkpoint belongs on shared storage: a lost executor or driver resumes from it.
    """
    return (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _folder(spark: SparkSession, path: str):
    """(file system, path) of a folder, wherever it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _parts(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """(what is read, what is superseded): sums up to a batch, and of the batches after it.

    A part counts once its writer has finished, so a reader never sees half of one.
    """
    files, folder = _folder(spark, path)
    names = [status.getPath().getName() for status in files.listStatus(folder)] if files.exists(folder) else []
    done = [name for name in names if files.exists(_folder(spark, f"{path}/{name}/_SUCCESS")[1])]
    number = {name: int(name.partition("=")[2]) for name in done if name.startswith(("upto=", "batch="))}
    base = max((n for name, n in number.items() if name.startswith("upto=")), default=-1)
    current = [name for name, n in number.items() if n == base and name.startswith("upto=") or n > base]
    return [f"{path}/{name}" for name in current], [f"{path}/{name}" for name in set(number) - set(current)]


def _stored_sums(spark: SparkSession, path: str) -> DataFrame | None:
    current, _ = _parts(spark, path)
    return functools.reduce(DataFrame.unionByName, [spark.read.parquet(part) for part in current]) if current else None


def window_sums(readings: DataFrame, window: str, keys: tuple[str, ...], columns: tuple[str, ...]) -> DataFrame:
    """Count and sums per window and key; sums of sums are sums, so batches can be added up."""
    grouped = readings.groupBy(F.window("timestamp", window).alias("_window"), *keys)
    sums = [F.sum(c).alias(f"sum_{c}") for c in columns]
    counts = [F.count(c).alias(f"n_{c}") for c in columns]
    return grouped.agg(F.count(F.lit(1)).alias("n"), *sums, *counts).select(
        F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"), *keys, "n",
        *[f"sum_{c}" for c in columns], *[f"n_{c}" for c in columns],
    )


def _added(sums: DataFrame, keys: list[str]) -> DataFrame:
    numbers = [c for c in sums.columns if c not in keys]
    return sums.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in numbers])


def upsert_windows(
    readings: DataFrame,
    path: str,
    checkpoint: str,
    window: str = WINDOW,
    keys: tuple[str, ...] = ("field_id",),
    columns: tuple[str, ...] = tuple(RANGES),
    fold_every: int = 16,
) -> StreamingQuery:
    """Keep sums of every window of the gated readings in a table, open and late ones included.

    Each batch adds its sums under its own number, so a batch that is repeated after a failure
    replaces what it wrote. Every ``fold_every`` batches, what is there becomes one part. There
    is no watermark: no reading is too late. Processes what is there and stops.
    """
    spark = readings.sparkSession

    def upsert(batch: DataFrame, number: int) -> None:
        sums = window_sums(gate(batch), window, keys, columns)
        sums.write.mode("overwrite").parquet(f"{path}/batch={number}")
        folded = f"{path}/upto={number}" in _parts(spark, path)[0]  # by an attempt before this one
        if number % fold_every == fold_every - 1 and not folded:
            whole = _added(_stored_sums(spark, path), ["window_start", "window_end", *keys])
            whole.write.mode("overwrite").parquet(f"{path}/upto={number}")
            # those of the fold before stay for readers that have begun; they go with the next
            for part in _parts(spark, path)[1]:
                if int(part.rpartition("=")[2]) <= number - fold_every:
                    files, folder = _folder(spark, part)
                    files.delete(folder, True)

    stream = readings.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
    return stream.trigger(availableNow=True).start()


def read_windows(
    spark: SparkSession, path: str, keys: tuple[str, ...] = ("field_id",), columns: tuple[str, ...] = tuple(RANGES)
) -> DataFrame:
    """The means of :func:`tumbling_means` from the table that a stream keeps."""
    stored = _stored_sums(spark, path)
    if stored is None:
        raise FileNotFoundError(f"no windows in {path}")
    whole = _added(stored, ["window_start", "window_end", *keys])
    means = [F.try_divide(f"sum_{c}", f"n_{c}").alias(c) for c in columns]
    return whole.select("window_start", "window_end", *keys, "n", *means)
