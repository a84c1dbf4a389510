"""Mapping of soil records, moisture resampling, enrichment and integration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlake.functions.numeric import row_mean
from fieldlake.operators import enrich
from fieldlake.operators.mapping import map_database_soil, map_local_soil, prefix_columns
from fieldlake.plans.integration import integrate, integrate_local
from fieldlake.sources.grids import raster_means
from workload.registry import query, rounded, time_text
from workload.views import (
    ANNUAL_CELL,
    ANNUAL_STEP,
    GRID,
    RAW_SOIL,
    SENSORS,
    grid,
    raw_soil,
    score_sql,
    table,
)

#: Rows whose distinct orders one task counts.
ROWS_PER_TASK = 1_000_000

_SCORE = score_sql(
    "'42' || field_id || coalesce(strftime(\"timestamp\", '%Y-%m-%d %H:%M:%S'), 'NaT')"
)


@query(f'WITH {ANNUAL_STEP} SELECT "year", round(moisture, 6) AS moisture FROM annual')
def annual_mean_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(enrich.annual_moisture(grid(spark, sf_dir), "step_mean"))


@query(f'WITH {ANNUAL_CELL} SELECT "year", round(moisture, 6) AS moisture FROM annual')
def annual_mean_of_cell_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(enrich.annual_moisture(grid(spark, sf_dir), "cell_month"))


@query(
    f"""WITH {GRID},
    monthly AS (SELECT lat, lon, date_trunc('month', "time") AS mon, avg(soil_moisture) AS m
                FROM grid GROUP BY 1, 2, 3),
    months AS (SELECT unnest(generate_series((SELECT min(mon) FROM monthly)::TIMESTAMP,
                 (SELECT max(mon) FROM monthly)::TIMESTAMP, INTERVAL 1 MONTH)) AS mon),
    places AS (SELECT DISTINCT lat, lon FROM monthly)
    SELECT p.lat, p.lon, CAST(last_day(CAST(months.mon AS DATE)) AS VARCHAR) AS period,
           round(m, 6) AS soil_moisture
    FROM places p CROSS JOIN months LEFT JOIN monthly y
      ON y.lat = p.lat AND y.lon = p.lon AND y.mon = months.mon"""
)
def monthly_mean_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = enrich.resample_mean(grid(spark, sf_dir), "month", ["lat", "lon"], label_end=True)
    return rounded(cells.withColumn("period", F.col("period").cast("string")))


def _soil_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    return items.select(
        "l_orderkey",
        "l_linenumber",
        F.year("l_shipdate").alias("year"),
        F.when(F.col("l_linenumber") != 1, F.col("l_discount") * 500).alias("moisture"),
    )


@query(
    f"""WITH {ANNUAL_STEP},
    soil AS (SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS INTEGER) AS "year",
             CASE WHEN l_linenumber <> 1 THEN l_discount * 500 END AS own FROM lineitem),
    merged AS (SELECT s.*, coalesce(a.moisture, own) AS m FROM soil s
               LEFT JOIN annual a ON a."year" = s."year")
    SELECT l_orderkey, l_linenumber, "year",
           round(coalesce(m, avg(m) OVER (PARTITION BY "year"), 30.0), 6) AS moisture
    FROM merged"""
)
def year_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    annual = enrich.annual_moisture(grid(spark, sf_dir))
    joined = enrich.join_annual(_soil_years(spark, sf_dir), annual, one_row_per_year=True)
    filled = enrich.fill_moisture(joined)
    return rounded(filled.select("l_orderkey", "l_linenumber", "year", "moisture"))


@query(
    """WITH pairs AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS "year",
                             CAST(month(o_orderdate) AS DOUBLE) AS moisture FROM orders),
    soil AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS "year", l_orderkey FROM lineitem)
    SELECT "year", moisture, count(*) AS n, count(DISTINCT l_orderkey) AS n_orders
    FROM soil LEFT JOIN pairs USING ("year") GROUP BY 1, 2"""
)
def year_enrichment_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several values per year multiply the rows; the join is sized by AQE.

    Rows of one order and year are counted before the join: each meets every value of its year
    once, so the rows joined are one per order and year, and distinct orders are counted as rows.
    They are dealt to as many tasks as they need, so that a task's orders are bounded.
    """
    orders = table(spark, sf_dir, "orders")
    monthly = orders.select(
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").cast("double").alias("moisture"),
    )
    items = table(spark, sf_dir, "lineitem")
    tasks = max(1, -(-items.count() // ROWS_PER_TASK))
    dealt = items.select(F.year("l_shipdate").alias("year"), "l_orderkey").repartition(tasks, "year", "l_orderkey")
    soils = dealt.groupBy("year", "l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    out = enrich.join_annual(soils, monthly).groupBy("year", "moisture")
    return out.agg(F.sum("n").alias("n"), F.count("l_orderkey").alias("n_orders"))


@query(
    """SELECT p_partkey, "year", "year" || '-01-01 00:00:00' AS "timestamp"
       FROM part, (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS "year" FROM orders)"""
)
def year_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.lit(None).cast("timestamp").alias("timestamp"),
        F.lit(None).cast("int").alias("year"),
    )
    years = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"))
    expanded = enrich.expand_years(parts, years)
    return expanded.select("p_partkey", "year", time_text("timestamp").alias("timestamp"))


@query(
    f"""WITH {RAW_SOIL}
    SELECT strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp", field_id,
      round(soil_ph, 6) AS soil_ph, round(nitrogen, 6) AS nitrogen,
      round(phosphorus, 6) AS phosphorus, round(potassium, 6) AS potassium,
      round({_SCORE}, 7) AS q_value FROM placed"""
)
def soil_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = map_database_soil(raw_soil(spark, sf_dir)).drop("moisture", "temperature")
    return mapped.withColumns(
        {
            "timestamp": time_text("timestamp"),
            **{c: F.round(c, 6) for c in ("soil_ph", "nitrogen", "phosphorus", "potassium")},
            "q_value": F.round("q_value", 7),
        }
    )


@query(
    """SELECT o_orderkey,
      CASE WHEN o_orderstatus <> 'P'
           THEN strftime(make_date(CAST(year(o_orderdate) AS INTEGER), 1, 1), '%Y-%m-%d %H:%M:%S')
           END AS "timestamp",
      CAST(o_orderkey AS VARCHAR) AS field_id,
      o_totalprice / 64 AS nitrogen, CAST(NULL AS DOUBLE) AS phosphorus,
      20.0::DOUBLE AS temperature
    FROM orders"""
)
def resolve_and_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year text or junk, a number among alternatives, text that is no number, absent columns."""
    orders = table(spark, sf_dir, "orders")
    year = F.year("o_orderdate").cast("string")
    raw = orders.select(
        F.when(F.col("o_orderstatus") == "P", "not recorded").otherwise(year).alias("Year"),
        F.lit("ignored").alias("YearPublication"),
        F.col("o_orderkey").cast("string").alias("field_id"),
        (F.col("o_totalprice") / 64).cast("string").alias("N_total"),
        F.lit("ignored").alias("Nitrogen"),
        F.col("o_orderpriority").alias("P"),
    )
    mapped = map_local_soil(raw)
    return mapped.select(
        F.col("field_id").cast("bigint").alias("o_orderkey"),
        time_text("timestamp").alias("timestamp"),
        "field_id",
        "nitrogen",
        "phosphorus",
        "temperature",
    )


@query(
    """SELECT l_orderkey, l_linenumber, round(list_avg(list_filter([
         CASE WHEN l_returnflag <> 'N' THEN l_quantity END,
         CASE WHEN l_linestatus <> 'O' THEN l_extendedprice END,
         CASE WHEN l_returnflag = 'R' THEN l_tax END], lambda x: x IS NOT NULL)), 6) AS mean
       FROM lineitem"""
)
def rowwise_mean_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    wide = items.select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_returnflag") != "N", F.col("l_quantity")).alias("P_C"),
        F.when(F.col("l_linestatus") != "O", F.col("l_extendedprice")).alias("p_t"),
        F.when(F.col("l_returnflag") == "R", F.col("l_tax")).alias("P"),
        F.col("l_discount").alias("PH_1"),
    )
    columns = [F.col(c) for c in prefix_columns(wide, "P")]
    return rounded(wide.select("l_orderkey", "l_linenumber", row_mean(columns).alias("mean")))


@query(
    """SELECT file, strftime(make_date(CAST(substr(regexp_replace(file, '[^0-9]', '', 'g'), 1, 4)
         AS INTEGER), 1, 1), '%Y-%m-%d %H:%M:%S') AS "time", round(avg(v), 6) AS soil_moisture
       FROM (SELECT CASE WHEN l_linenumber <= 4 THEN 'SM' || year(l_shipdate) || '.tif'
                         ELSE 'sm_v' || l_linenumber || '_' || year(l_shipdate) || '.tif' END AS file,
                    CASE WHEN l_returnflag <> 'N' THEN l_extendedprice / 1000 END AS v
             FROM lineitem) GROUP BY 1"""
)
def raster_file_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels of many raster files; digits of a whole file name run together."""
    items = table(spark, sf_dir, "lineitem")
    year = F.year("l_shipdate")
    plain = F.concat(F.lit("SM"), year, F.lit(".tif"))
    versioned = F.concat(F.lit("sm_v"), F.col("l_linenumber"), F.lit("_"), year, F.lit(".tif"))
    pixels = items.select(
        F.when(F.col("l_linenumber") <= 4, plain).otherwise(versioned).alias("file"),
        F.when(F.col("l_returnflag") != "N", F.col("l_extendedprice") / 1000).alias("value"),
    )
    return rounded(raster_means(pixels).withColumn("time", time_text("time")))


_CLAMPED = """
  greatest(3.5::DOUBLE, least(9::DOUBLE, soil_ph)) AS soil_ph,
  greatest(0::DOUBLE, least(100::DOUBLE, nitrogen)) AS nitrogen,
  greatest(0::DOUBLE, least(50::DOUBLE, phosphorus)) AS phosphorus,
  greatest(0::DOUBLE, least(100::DOUBLE, potassium)) AS potassium,
  greatest(0::DOUBLE, least(100::DOUBLE, moisture)) AS moisture"""
_MEANS = ", ".join(
    f"round(avg({c}), 6) AS {c}"
    for c in ("soil_ph", "nitrogen", "phosphorus", "potassium", "moisture")
) + ", round(max(q_value), 7) AS q_value"


@query(
    f"""WITH {RAW_SOIL}, {ANNUAL_STEP},
    merged AS (SELECT p.*, {_SCORE} AS q_value, a.moisture AS m FROM placed p
               LEFT JOIN annual a ON a."year" = p."year"),
    filled AS (SELECT *, coalesce(m, CASE WHEN "year" IS NOT NULL
               THEN avg(m) OVER (PARTITION BY "year") END, 30.0) AS moisture FROM merged),
    gated AS (SELECT "timestamp", "year", field_id, q_value, {_CLAMPED} FROM filled
              WHERE "timestamp" IS NOT NULL AND soil_ph IS NOT NULL)
    SELECT field_id, "year", count(*) AS n, {_MEANS} FROM gated GROUP BY 1, 2"""
)
def integrate_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = integrate(raw_soil(spark, sf_dir), grid(spark, sf_dir))
    return _field_years(merged)


@query(
    f"""WITH {RAW_SOIL}, {ANNUAL_STEP},
    available AS (SELECT "year" AS y FROM annual),
    expanded AS (SELECT p.* REPLACE (y AS "year", make_date(y, 1, 1)::TIMESTAMP AS "timestamp"),
                 {score_sql("'42' || field_id || 'NaT'")} AS q_value FROM placed p, available),
    filled AS (SELECT e.*, coalesce(a.moisture, 30.0) AS moisture FROM expanded e
               LEFT JOIN annual a ON a."year" = e."year"),
    gated AS (SELECT "timestamp", "year", field_id, q_value, {_CLAMPED} FROM filled)
    SELECT field_id, "year", count(*) AS n, {_MEANS} FROM gated GROUP BY 1, 2"""
)
def integrate_yearless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records without any usable year are repeated over all moisture years."""
    raw = raw_soil(spark, sf_dir).withColumn("SamplingYear", F.lit("unknown"))
    return _field_years(integrate(raw, grid(spark, sf_dir)))


@query(
    f"""WITH {RAW_SOIL}, {ANNUAL_CELL},
    merged AS (
      SELECT r.record, r.line, make_date(r."year", 1, 1)::TIMESTAMP AS "timestamp", r."year",
        'plot_' || (r.record % 50) AS field_id, r.soil_ph, r.nitrogen,
        r.phosphorus, r.potassium, a.moisture AS m
      FROM raw_soil r LEFT JOIN annual a ON a."year" = r."year"),
    filled AS (SELECT *, {_SCORE} AS q_value, coalesce(m, CASE WHEN "year" IS NOT NULL
               THEN avg(m) OVER (PARTITION BY "year") END, 30.0) AS moisture FROM merged),
    gated AS (SELECT "timestamp", "year", field_id, q_value, {_CLAMPED} FROM filled
              WHERE "timestamp" IS NOT NULL)
    SELECT field_id, "year", count(*) AS n, {_MEANS} FROM gated GROUP BY 1, 2"""
)
def integrate_by_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_soil(spark, sf_dir)
    mean = row_mean([F.col("pH_C"), F.col("pH_T")])
    named = raw.select(
        "SamplingYear",
        F.concat(F.lit("plot_"), F.col("record") % 50).alias("field_id"),
        mean.alias("SoilpH"),
        F.col("N_C").alias("Nitrogen"),
        F.col("P_C").alias("P_total"),
        "K",
    )
    return _field_years(integrate_local(named, grid(spark, sf_dir)))


def _field_years(merged: DataFrame) -> DataFrame:
    columns = ["soil_ph", "nitrogen", "phosphorus", "potassium", "moisture"]
    means = merged.groupBy("field_id", "year").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.round(F.avg(c), 6).alias(c) for c in columns],
        F.round(F.max("q_value"), 7).alias("q_value"),
    )
    return means


@query(
    f"""WITH {SENSORS},
    where_ AS (SELECT event_id, user_id % 7 AS lat, user_id % 3 AS lon, event_type, value,
                      CAST(ts AS DATE) AS "day" FROM events),
    weather AS (SELECT lat, lon, "day", avg(value / 11) AS w FROM where_
                WHERE event_type IN ('view', 'error') GROUP BY 1, 2, 3)
    SELECT e.event_id, round(coalesce(CASE WHEN s.moisture >= 50 THEN s.temperature END, w), 6)
           AS temperature
    FROM where_ e JOIN sensors s USING (event_id)
    LEFT JOIN weather ON weather.lat = e.lat AND weather.lon = e.lon AND weather."day" = e."day\""""
)
def temperature_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Temperatures missing where it is dry, taken from a weather table by place and day."""
    events = table(spark, sf_dir, "events")
    place = [
        (F.col("user_id") % 7).cast("double").alias("lat"),
        (F.col("user_id") % 3).cast("double").alias("lon"),
    ]
    k = F.get_json_object("props", "$.k").try_cast("double")
    readings = events.select(
        "event_id",
        F.col("ts").alias("timestamp"),
        *place,
        F.when((k >= 3) & (1.2 * k - 5 >= 50), F.col("value") / 4.1 - 22).alias("temperature"),
    )
    measured = F.when(F.col("event_type").isin("view", "error"), F.col("value") / 11)
    weather = events.select(*place, F.col("ts").alias("date"), measured.alias("temperature"))
    return rounded(enrich.fill_temperature(readings, weather).select("event_id", "temperature"))
