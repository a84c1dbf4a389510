"""CSV, partitioned Parquet and catalog-table sinks."""

from __future__ import annotations

import logging
import uuid

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from fieldlake.operators.quality import gate

log = logging.getLogger(__name__)

_MODES = {"replace": "overwrite", "overwrite": "overwrite", "append": "append", "error": "error"}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Part files with a header row; timestamps keep microseconds so that they round-trip."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        .csv(path)
    )
    return path


def _by_day(df: DataFrame, timestamp: str, day: str, cluster_by: list[str]) -> DataFrame:
    """Rows gathered per day and sorted within.

    The rebalance hint lets AQE split a day that holds far more rows than others, and join
    small ones, so that files come out evenly sized whatever the skew.
    """
    dated = df.withColumn(day, F.to_date(timestamp))
    return dated.hint("rebalance", day).sortWithinPartitions(day, *cluster_by)


def load_readings(
    readings: DataFrame,
    path: str,
    if_exists: str = "replace",
    timestamp: str = "timestamp",
    cluster_by: tuple[str, ...] = ("field_id",),
    check: bool = True,
    replace_days_only: bool = False,
) -> str:
    """Gate the readings and write them partitioned by day; returns the path.

    ``if_exists`` is ``replace``, ``append`` or ``error``. With ``replace_days_only`` a replace
    touches just the days present in ``readings``.
    """
    checked = gate(readings) if check else readings
    writer = (
        _by_day(checked, timestamp, "day", list(cluster_by))
        .write.mode(_MODES[if_exists])
        .partitionBy("day")
    )
    if replace_days_only:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return path


def load_readings_table(
    readings: DataFrame,
    table: str,
    if_exists: str = "replace",
    timestamp: str = "timestamp",
    bucket_by: str = "field_id",
    buckets: int = 32,
) -> str:
    """Like :func:`load_readings` into a catalog table, bucketed for joins on ``bucket_by``.

    Rebalanced on both keys: a field that dominates a day is split over several tasks, which
    only means several files in its bucket. A replacement is staged as by :func:`replace_table`.
    """
    checked = gate(readings).withColumn("day", F.to_date(timestamp))
    writer = checked.hint("rebalance", "day", bucket_by).write.partitionBy("day").bucketBy(buckets, bucket_by)
    writer = writer.sortBy(bucket_by).format("parquet")
    if if_exists in ("replace", "overwrite"):
        return _staged(readings.sparkSession, table, writer)
    writer.mode(_MODES[if_exists]).saveAsTable(table)
    return table


def replace_table(df: DataFrame, table: str) -> str:
    """Create or replace a catalog table from a query, which may read that table.

    The rows are written aside; the name moves to them once they are all there, so a reader
    finds the old rows or the new ones, and a failure on the way leaves the old ones in place.
    """
    return _staged(df.sparkSession, table, df.write.format("parquet"))


def _staged(spark: SparkSession, table: str, writer: DataFrameWriter) -> str:
    """Write a new version next to the old one, then give it the name.

    Versions are external tables, so their names change without any file being touched. Where the
    new one cannot take the name, the old one gets it back. The version that is replaced
    keeps its files for readers that have begun; those of the one before it go.
    """
    mark = uuid.uuid4().hex
    *place, name = table.split(".")
    fresh, old = (".".join([*place, f"{name}__{kind}_{mark}"]) for kind in ("new", "old"))
    home = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table}.versions"
    path = f"{home}/{mark}"
    try:
        writer.mode("error").option("path", path).saveAsTable(fresh)
        exists = spark.catalog.tableExists(table)
        before = _location(spark, table) if exists else None
        if exists:
            spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
        try:
            spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
        except PySparkException:
            if exists:
                spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
            raise
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        _remove(spark, path)
        raise
    if exists:
        spark.sql(f"DROP TABLE {old}")
    _keep_only(spark, home, {path, before})
    return table


def _location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'")
    return described.first()["data_type"]


def _remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _keep_only(spark: SparkSession, home: str, paths: set[str | None]) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(home)
    kept = {path.rstrip("/").rsplit("/", 1)[-1] for path in paths if path}
    for status in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder):
        if status.getPath().getName() not in kept:
            _remove(spark, status.getPath().toString())


def replace_parquet(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def load_or_csv(readings: DataFrame, path: str, fallback_path: str | None = None, **options) -> str:
    """Load the readings; if that fails and a fallback is given, write CSV there instead."""
    try:
        return load_readings(readings, path, **options)
    except (PySparkException, ValueError):
        if fallback_path is None:
            raise
        log.exception("load into %s failed, writing CSV to %s", path, fallback_path)
        return write_csv(readings, fallback_path)


def write_model_summary(summary: DataFrame, path: str) -> str:
    """The one-row result of a fit as a single JSON line."""
    summary.coalesce(1).write.mode("overwrite").json(path)
    return path
