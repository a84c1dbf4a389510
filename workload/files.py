"""Files written and read back: many shapes of soil files, texts, tables of the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlake.operators import aggregates, quality
from fieldlake.operators.stats import linear_fit, model_summary
from fieldlake.sinks.writers import load_or_csv, load_readings_table, replace_table, write_model_summary
from fieldlake.session import scratch_path
from fieldlake.sources.documents import read_text_files
from fieldlake.sources.soil_files import read_soil_files
from fieldlake.sources.tables import read_table
from workload.registry import query, rounded
from workload.views import GATED, SENSORS, sensors, table


@query(
    """SELECT l_orderkey::VARCHAR AS order_key, l_linenumber::VARCHAR AS line,
      CASE WHEN l_returnflag <> 'N' THEN year(l_shipdate)::VARCHAR END AS "Year",
      CASE l_returnflag WHEN 'R' THEN 'says "' || l_linestatus || '", ' || l_linenumber
                        WHEN 'A' THEN 'line' || chr(10) || l_linestatus END AS note,
      CASE WHEN l_returnflag = 'N' THEN CAST(l_quantity AS BIGINT)::VARCHAR END AS quantity FROM lineitem"""
)
def soil_files_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three shapes of files: quoted CSV, CSV with records over two lines, and Parquet."""
    root = scratch_path(spark, "soil-files")
    items = table(spark, sf_dir, "lineitem")
    year, status = F.year("l_shipdate"), F.col("l_linestatus")
    quoted = F.concat(F.lit('says "'), status, F.lit('", '), F.col("l_linenumber").cast("string"))
    written = {"header": True, "escape": '"'}
    items.filter("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line"), year.alias("Year"), quoted.alias("note")
    ).write.options(**written).csv(f"{root}/a")
    items.filter("l_returnflag = 'A'").select(
        F.concat(F.lit("line\n"), status).alias("note"), year.alias("YEAR"), F.col("l_linenumber").alias("line"),
        F.col("l_orderkey").alias("order_key"),
    ).write.options(**written).csv(f"{root}/b/deeper")
    items.filter("l_returnflag = 'N'").select(
        F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line"), F.col("l_quantity").cast("long").alias("quantity")
    ).write.parquet(f"{root}/c")
    return read_soil_files(spark, root).table.select("order_key", "line", "Year", "note", "quantity")


@query(
    """SELECT lang, "source", sum(length(replace(replace(text, chr(10), ' '), chr(13), ' ')) + 1)::BIGINT AS n_chars
       FROM documents GROUP BY ALL"""
)
def whole_text_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts written to a folder per language and source, and read back as whole files."""
    path = scratch_path(spark, "texts")
    lines = table(spark, sf_dir, "documents").select(
        F.regexp_replace("text", r"[\r\n]", " ").alias("value"), "lang", "source"
    )
    lines.write.partitionBy("lang", "source").text(path)
    found = read_text_files(spark, f"{path}/*/*/*.txt")
    place = lambda name: F.regexp_extract("doc_id", f"/{name}=([^/]*)/", 1).alias(name)
    return found.groupBy(place("lang"), place("source")).agg(F.sum(F.length("text")).alias("n_chars"))


@query(
    """SELECT o_orderpriority, count(*) AS n, round(avg(o_totalprice), 6) AS mean_price FROM orders
       WHERE o_totalprice > 1000 GROUP BY 1"""
)
def catalog_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of the catalog made from a query, replaced by another one, and read by name."""
    orders = table(spark, sf_dir, "orders")
    name = replace_table(orders.limit(0), "fieldlake_orders")
    replace_table(orders.filter("o_totalprice > 1000"), name)
    found = read_table(spark, name).groupBy("o_orderpriority")
    return rounded(found.agg(F.count("*").alias("n"), F.avg("o_totalprice").alias("mean_price")))


@query(
    f"""WITH {SENSORS}, {GATED} SELECT CAST(CAST("timestamp" AS DATE) AS VARCHAR) AS "day", field_id, count(*) AS n
        FROM gated GROUP BY 1, 2"""
)
def catalog_bucketed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings in a bucketed table, replaced by themselves, counted per day and bucket key."""
    readings = sensors(spark, sf_dir)
    for _ in range(2):
        name = load_readings_table(readings, "fieldlake_readings", buckets=8)
    found = read_table(spark, name).groupBy(F.col("day").cast("string").alias("day"), "field_id")
    return found.agg(F.count("*").alias("n"))


@query(
    f"""WITH {SENSORS} SELECT field_id, count(*) AS n, CAST(count(moisture) AS BIGINT) AS n_moisture FROM sensors GROUP BY 1"""
)
def csv_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that fails, because a required column is not there, goes on as CSV."""
    root = scratch_path(spark, "fallback")
    path = load_or_csv(sensors(spark, sf_dir).drop("soil_ph"), f"{root}/table", f"{root}/csv")
    found = spark.read.option("header", True).csv(path)
    return found.groupBy("field_id").agg(F.count("*").alias("n"), F.count("moisture").alias("n_moisture"))


@query(
    """SELECT 'fitted' AS status, round(regr_slope(l_extendedprice, l_quantity), 4) AS coef,
      round(regr_r2(l_extendedprice, l_quantity), 6) AS r2, count(*) AS n FROM lineitem"""
)
def model_summary_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of a fit, written as a line of JSON and read back."""
    items = table(spark, sf_dir, "lineitem")
    summary = model_summary(linear_fit(items, "l_quantity", "l_extendedprice"), items)
    path = write_model_summary(summary, scratch_path(spark, "summary"))
    found = spark.read.json(path)
    return found.select("status", F.round("coef", 4).alias("coef"), F.round("r2", 6).alias("r2"), "n")


@query(
    f"""WITH {SENSORS} SELECT 'Missing required columns: [''potassium'', ''moisture'']' AS message, count(*) AS n FROM sensors"""
)
def missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the gate says of readings without two of their columns."""
    readings = sensors(spark, sf_dir)
    try:
        quality.check_columns(readings.drop("moisture", "potassium"))
        message = ""
    except ValueError as error:
        message = str(error)
    return quality.check_columns(readings).agg(F.lit(message).alias("message"), F.count("*").alias("n"))


@query(
    f"""WITH {SENSORS} SELECT (SELECT count(DISTINCT field_id) FROM sensors) AS n_distinct, field_id,
      (SELECT bool_or(moisture IS NULL) FROM sensors) AS any_gap, (SELECT bool_and(moisture IS NULL) FROM sensors) AS all_gap,
      (SELECT count(*) FROM sensors WHERE q_value > 0.7) AS n_above
      FROM sensors WHERE field_id IS NOT NULL GROUP BY field_id"""
)
def distinct_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct values as rows, with one-row figures of the table beside them."""
    readings = sensors(spark, sf_dir)
    gaps = aggregates.holds(readings, F.col("moisture").isNull())
    return aggregates.distinct_values(readings, "field_id").select(
        aggregates.distinct_count(readings, "field_id").scalar().alias("n_distinct"),
        "field_id",
        gaps.select("any").scalar().alias("any_gap"),
        gaps.select("all").scalar().alias("all_gap"),
        quality.count_above(readings).scalar().alias("n_above"),
    )
