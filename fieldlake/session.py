"""Session-level helpers: time zone, shared scratch folder, checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone: readings are UTC and every hour/day boundary relies on it."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ship_package(spark: SparkSession) -> SparkSession:
    """Make this package importable in the Python workers, once per application.

    Needed where it is not installed on the executors; only the Arrow kernels use it there.
    """
    context = spark.sparkContext
    if getattr(context, "_fieldlake_shipped", False):
        return spark
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="fieldlake-package-"), "fieldlake.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, files in os.walk(package):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    context._fieldlake_shipped = True
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by the session.

    Where the setting is missing, a local master gets a folder of its own, as in tests; on a
    cluster that is an error, because no folder of the driver is shared.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    local = tempfile.mkdtemp(prefix="fieldlake-")
    spark.conf.set(CHECKPOINT_CONF, local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/fieldlake/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, so that what made it runs once. Eager."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def fits(df: DataFrame, max_rows: int) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows; reads no more than that plus one."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` behind a row-count check; unhinted beyond it.

    Unhinted, the join becomes a shuffled one whose skewed partitions AQE splits.
    """
    return F.broadcast(df) if fits(df, max_rows) else df
