"""The domain tables as views of the driver's tables, in Spark and in SQL.

Each view covers its whole table: it renames and derives columns, and leaves no row out. The
odd divisors keep means off the exact halves that engines round differently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlake.functions.identity import deterministic_score
from fieldlake.functions.temporal import second_text
from fieldlake.session import ship_package
from fieldlake.sources.grids import moisture_grid
from fieldlake.schema import RANGES
from fieldlake.sources.tables import normalise, read_parquet


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return normalise(read_parquet(ship_package(spark), f"{sf_dir}/{name}.parquet"))


def sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings from ``events``, with the event id kept as a key."""
    return as_readings(table(spark, sf_dir, "events"))


def as_readings(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").try_cast("double")
    return events.withColumn("k", k).select(
        "event_id",
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("field_"), F.col("user_id") % 5 + 1).alias("field_id"),
        (3 + F.col("value") / 41).alias("soil_ph"),
        (F.col("value") / 2.1).alias("nitrogen"),
        (0.6 * F.col("k")).alias("phosphorus"),
        (F.col("value") / 3).alias("potassium"),
        F.when(F.col("k") >= 3, 1.2 * F.col("k") - 5).alias("moisture"),
        (F.col("value") / 4.1 - 22).alias("temperature"),
        F.col("event_type").alias("scenario"),
        deterministic_score(F.col("event_id"), second_text(F.col("ts"))).alias("q_value"),
    )


def score_sql(text: str) -> str:
    return f"CAST(('0x' || substr(sha256({text}), 1, 16))::UBIGINT % 10000000 AS DOUBLE) / 1e7"


SENSORS = f"""
sensors AS (
  SELECT event_id, ts AS "timestamp", 'field_' || (user_id % 5 + 1) AS field_id,
         3 + value / 41 AS soil_ph, value / 2.1 AS nitrogen, 0.6 * k AS phosphorus,
         value / 3 AS potassium, CASE WHEN k >= 3 THEN 1.2 * k - 5 END AS moisture,
         value / 4.1 - 22 AS temperature, event_type AS scenario,
         {score_sql("'42' || event_id || strftime(ts, '%Y-%m-%d %H:%M:%S') || CASE WHEN microsecond(ts) % 1000000 = 0 THEN '' ELSE strftime(ts, '.%f') END")} AS q_value
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events))
"""

def clamp_sql(relation: str) -> str:
    """Select list that clamps the measurements; a NULL saturates to the upper bound."""
    clamped = ", ".join(
        f"greatest({lo}::DOUBLE, least({hi}::DOUBLE, {c})) AS {c}" for c, (lo, hi) in RANGES.items()
    )
    return f"SELECT * REPLACE ({clamped}) FROM {relation}"


COMPLETE_SQL = " AND ".join(
    f"{c} IS NOT NULL"
    for c in ['"timestamp"', "field_id", *RANGES, "q_value"]
)

GATED = f"""
gated AS ({clamp_sql(f"(SELECT * FROM sensors WHERE {COMPLETE_SQL})")})
"""


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moisture grid from ``orders``: 35 cells, gaps, and 1997 without any value."""
    orders = table(spark, sf_dir, "orders")
    usable = (F.col("o_orderstatus") != "P") & (F.year("o_orderdate") != 1997)
    return moisture_grid(
        orders.select(
            F.col("o_orderdate").alias("time"),
            (10 + F.col("o_custkey") % 7).cast("double").alias("lat"),
            (20 + F.col("o_custkey") % 5).cast("double").alias("lon"),
            F.when(usable, F.col("o_totalprice") / 4999).alias("soil_moisture"),
        )
    )


GRID = """
grid AS (
  SELECT o_orderdate AS "time", CAST(10 + o_custkey % 7 AS DOUBLE) AS lat,
         CAST(20 + o_custkey % 5 AS DOUBLE) AS lon,
         CASE WHEN o_orderstatus <> 'P' AND year(o_orderdate) <> 1997
              THEN o_totalprice / 4999 END AS soil_moisture
  FROM orders)
"""

ANNUAL_STEP = f"""
{GRID},
steps AS (SELECT "time", avg(soil_moisture) AS m FROM grid GROUP BY 1),
observed AS (SELECT year("time") AS "year", avg(m) AS moisture FROM steps GROUP BY 1),
annual AS (
  SELECT CAST(y AS INTEGER) AS "year", moisture
  FROM (SELECT unnest(generate_series((SELECT min("year") FROM observed),
                                      (SELECT max("year") FROM observed))) AS y)
  LEFT JOIN observed ON observed."year" = y)
"""

ANNUAL_CELL = f"""
{GRID},
cells AS (SELECT lat, lon, date_trunc('month', "time") AS mon, avg(soil_moisture) AS m
          FROM grid GROUP BY 1, 2, 3),
annual AS (SELECT CAST(year(mon) AS INTEGER) AS "year", avg(m) AS moisture FROM cells GROUP BY 1)
"""


def raw_soil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loosely formatted soil records from ``lineitem``: text columns with junk in them."""
    items = table(spark, sf_dir, "lineitem")
    year = F.year("l_shipdate").cast("string")
    return items.select(
        F.col("l_orderkey").alias("record"),
        F.col("l_linenumber").alias("line"),
        (F.col("l_partkey") % 40 / 4 - 5).cast("string").alias("Latitude"),
        (F.col("l_suppkey") % 50 / 4).cast("string").alias("Longitude"),
        F.when(F.col("l_linenumber") == 7, "unknown").otherwise(year).alias("SamplingYear"),
        (F.col("l_quantity") / 7).cast("string").alias("pH_C"),
        F.when(F.col("l_returnflag") != "R", (F.col("l_quantity") / 9).cast("string"))
        .otherwise("n/a")
        .alias("pH_T"),
        (F.col("l_extendedprice") / 1009).cast("string").alias("N_C"),
        F.col("l_linestatus").alias("N_T"),
        (F.col("l_discount") * 400).cast("string").alias("P_C"),
        (F.col("l_tax") * 1000).cast("string").alias("K"),
    )


RAW_SOIL = """
raw_soil AS (
  SELECT l_orderkey AS record, l_linenumber AS line,
         (l_partkey % 40) / 4.0::DOUBLE - 5 AS lat, (l_suppkey % 50) / 4.0::DOUBLE AS lon,
         CASE WHEN l_linenumber <> 7 THEN CAST(year(l_shipdate) AS INTEGER) END AS "year",
         CASE WHEN l_returnflag <> 'R' THEN (l_quantity / 7 + l_quantity / 9) / 2
              ELSE l_quantity / 7 END AS soil_ph,
         l_extendedprice / 1009 AS nitrogen, l_discount * 400 AS phosphorus,
         l_tax * 1000 AS potassium
  FROM lineitem),
placed AS (
  SELECT *, 'grid_' || CAST(round(lat, 3) AS VARCHAR) || '_' || CAST(round(lon, 3) AS VARCHAR)
            AS field_id,
         make_date("year", 1, 1)::TIMESTAMP AS "timestamp"
  FROM raw_soil)
"""
