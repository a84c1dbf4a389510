"""Quality gate, aggregates, serialisation, sinks and the stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlake.functions.identity import grid_field_id
from fieldlake.functions.numeric import binary_to_long
from fieldlake.functions.temporal import epoch_seconds, floor_window, iso_text, parse_timestamp
from fieldlake.functions.text import title_words
from fieldlake.operators import aggregates, quality
from fieldlake.operators.mapping import with_row_id
from fieldlake.operators.ranges import number_within
from fieldlake.operators.rows import distinct_rows, top_n, union_by_name
from fieldlake.operators.serialise import JSON_FIELDS, row_json, with_prompt, with_recommendation
from fieldlake.schema import RANGES
from fieldlake.session import scratch_path, use_utc
from fieldlake.sinks.writers import load_readings, replace_parquet, write_csv
from fieldlake.sources.profile import profile
from fieldlake.sources.tables import normalise
from fieldlake.streaming.gate import (
    gated_means,
    read_stream,
    read_windows,
    tumbling_means,
    upsert_windows,
    write_available,
)
from workload.registry import joined, query, rounded, time_text
from workload.views import COMPLETE_SQL, GATED, SENSORS, as_readings, clamp_sql, sensors, table

_MEASURES = list(RANGES)


def _avgs(columns, digits: int = 6) -> str:
    return ", ".join(f"round(avg({c}), {digits}) + 0.0 AS {c}" for c in columns)


@query(
    f"""WITH {SENSORS}, {GATED}
    SELECT field_id, {_avgs([*_MEASURES, "q_value"])} FROM gated GROUP BY 1"""
)
def sensor_gate_by_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    gated = quality.gate(sensors(spark, sf_dir))
    return rounded(aggregates.mean_by(gated, ["field_id"], [*_MEASURES, "q_value"]))


@query(
    f"WITH {SENSORS}, clamped AS ({clamp_sql('sensors')})\n"
    + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS measure, count(*) FILTER ({c} = {lo}) AS n_low, "
        f"count(*) FILTER ({c} = {hi}) AS n_high FROM clamped"
        for c, (lo, hi) in RANGES.items()
    )
)
def clamp_saturation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    clamped = quality.clamp_ranges(sensors(spark, sf_dir))
    counts = clamped.agg(
        *[F.count_if(F.col(c) == lo).alias(f"low_{c}") for c, (lo, _) in RANGES.items()],
        *[F.count_if(F.col(c) == hi).alias(f"high_{c}") for c, (_, hi) in RANGES.items()],
    )
    rows = [
        F.struct(
            F.lit(c).alias("measure"),
            F.col(f"low_{c}").alias("n_low"),
            F.col(f"high_{c}").alias("n_high"),
        )
        for c in RANGES
    ]
    return counts.select(F.inline(F.array(*rows)))


@query(
    f"""WITH {SENSORS}
    SELECT scenario, count(*) AS n, round(avg(soil_ph), 6) AS soil_ph FROM sensors
    WHERE {" AND ".join(f"{c} BETWEEN {lo} AND {hi}" for c, (lo, hi) in RANGES.items())}
    GROUP BY 1"""
)
def range_mask_by_scenario(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = quality.keep_in_range(sensors(spark, sf_dir))
    out = kept.groupBy("scenario").agg(F.count(F.lit(1)).alias("n"), F.avg("soil_ph").alias("soil_ph"))
    return rounded(out)


_VIOLATIONS = "list_filter([" + ", ".join(
    [f"CASE WHEN {c} IS NULL THEN '{c}:missing' END" for c in [*_MEASURES, "q_value", "field_id"]]
    + [f"CASE WHEN {c} < {lo} THEN '{c}:low' END" for c, (lo, _) in RANGES.items()]
    + [f"CASE WHEN {c} > {hi} THEN '{c}:high' END" for c, (_, hi) in RANGES.items()]
) + "], lambda x: x IS NOT NULL)"


@query(
    f"""WITH {SENSORS}, tagged AS (SELECT *, {_VIOLATIONS} AS violations FROM sensors)
    SELECT coalesce(violation, 'clean') AS violation, count(*) AS n
    FROM (SELECT unnest(CASE WHEN len(violations) = 0 THEN ['clean'] ELSE violations END)
                 AS violation FROM tagged) GROUP BY 1"""
)
def quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = quality.with_violations(sensors(spark, sf_dir))
    labels = F.when(F.size("violations") == 0, F.array(F.lit("clean"))).otherwise(F.col("violations"))
    return aggregates.count_by(tagged.select(F.explode(labels).alias("violation")), "violation")


@query(
    f"""WITH {SENSORS} SELECT event_id, array_to_string(list_sort({_VIOLATIONS}), '|')
    AS violations FROM sensors WHERE len({_VIOLATIONS}) > 0"""
)
def quarantined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = quality.quarantine(sensors(spark, sf_dir))
    return rejected.select("event_id", joined(F.array_sort("violations")).alias("violations"))


_DEC = "CAST(CAST({0} AS DECIMAL(20,6)) AS VARCHAR)"


@query(
    f"""WITH {SENSORS}
    SELECT event_id, field_id,
      'Soil pH=' || {_DEC.format("soil_ph")} || '; N=' || {_DEC.format("nitrogen")} ||
      '; K=' || {_DEC.format("potassium")} || '; moisture=' || {_DEC.format("moisture")} AS prompt
    FROM sensors WHERE "timestamp" > (SELECT max("timestamp") FROM sensors) - INTERVAL 7 DAY
    ORDER BY "timestamp", event_id LIMIT 20"""
)
def recent_window_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = sensors(spark, sf_dir)
    as_of = readings.agg(F.max("timestamp")).scalar()
    prompts = with_prompt(quality.recent(readings, as_of), digits=6)
    first = top_n(prompts, [F.asc("timestamp"), F.asc("event_id")], 20)
    return first.select("event_id", "field_id", "prompt")


@query(f"WITH {SENSORS} SELECT event_id, q_value FROM sensors")
def score_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sensors(spark, sf_dir).select("event_id", "q_value")


@query(
    """SELECT 'grid_' || CAST(round(value / 5 - 45, 3) AS VARCHAR) || '_' ||
              CAST(round(user_id * 1.5::DOUBLE - 110, 3) AS VARCHAR) AS field_id, count(*) AS n
       FROM events GROUP BY 1"""
)
def grid_field_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    where = grid_field_id(F.col("value") / 5 - 45, F.col("user_id") * 1.5 - 110)
    return aggregates.count_by(events.select(where.alias("field_id")), "field_id")


@query(
    f"""WITH {SENSORS}
    SELECT CASE WHEN q_value < 0.3 THEN 'low' WHEN q_value <= 0.7 THEN 'medium' ELSE 'high' END
           AS tier, count(*) AS n, count(*) FILTER (q_value > 0.7) AS n_above
    FROM sensors GROUP BY 1"""
)
def q_band_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiers = quality.with_tier(sensors(spark, sf_dir))
    return tiers.groupBy("tier").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("q_value") > 0.7).alias("n_above")
    )


_WINDOWED = f"""
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, field_id, count(*) AS n,
       {_avgs(_MEASURES)}
FROM (SELECT *, to_timestamp(floor(epoch("timestamp") / 900) * 900) AT TIME ZONE 'UTC' AS w
      FROM gated)
"""


@query(f"WITH {SENSORS}, {GATED} {_WINDOWED} GROUP BY w, field_id")
def tumbling_15min_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = tumbling_means(quality.gate(sensors(spark, sf_dir)))
    named = means.withColumn("window_start", time_text("window_start")).drop("window_end")
    return rounded(named)


@query(
    f"""WITH {SENSORS}, {GATED} {_WINDOWED}
    WHERE w + INTERVAL 15 MINUTE <= (SELECT max("timestamp") FROM gated) - INTERVAL 1 HOUR
    GROUP BY w, field_id"""
)
def stream_gate_15min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows closed once the stream of all events has been drained."""
    use_utc(spark)
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    )
    readings = as_readings(normalise(stream))
    out = scratch_path(spark, "stream")
    write_available(gated_means(readings), f"{out}/data", f"{out}/state").awaitTermination()
    means = spark.read.parquet(f"{out}/data")
    named = means.withColumn("window_start", time_text("window_start")).drop("window_end")
    return rounded(named)


@query(f"WITH {SENSORS}, {GATED} {_WINDOWED} GROUP BY w, field_id")
def stream_windows_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All windows of the drained stream, those of the last hour among them."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = read_stream(spark, sf_dir, schema, "events.parquet")
    out = scratch_path(spark, "windows")
    upsert_windows(as_readings(normalise(stream)), f"{out}/data", f"{out}/state").awaitTermination()
    named = read_windows(spark, f"{out}/data").withColumn("window_start", time_text("window_start"))
    return rounded(named.drop("window_end"))


_DAYS = [f"2024-01-{day:02d}" for day in range(1, 31)]


@query(
    f"""WITH {SENSORS}
    SELECT field_id, {", ".join(
        f'''round(avg(moisture) FILTER (CAST("timestamp" AS DATE) = '{d}'), 6) + 0.0 AS "{d}"'''
        for d in _DAYS)}
    FROM sensors GROUP BY 1"""
)
def pivot_field_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("timestamp", "yyyy-MM-dd")
    return rounded(aggregates.pivot_mean(sensors(spark, sf_dir), "field_id", day, "moisture"))


_WORDS = ["anvil", "blue", "bolt", "cold", "gear", "gizmo", "hot", "large", "new", "old", "plate",
          "red", "ring", "rod", "small", "widget"]


@query(
    f"""SELECT p_brand, {", ".join(
        f"CAST(max(CASE WHEN list_contains(string_split(p_name, ' '), '{w}') THEN 1 ELSE 0 END) "
        f"AS BIGINT) AS {w}" for w in _WORDS)} FROM part GROUP BY 1"""
)
def indicator_by_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "part").select("p_brand", F.split("p_name", " ").alias("words"))
    return aggregates.indicator_matrix(words, "p_brand", "words", title=False)


@query(
    """SELECT word, count(*) AS n FROM
       (SELECT unnest(list_distinct(string_split(p_name, ' '))) AS word FROM part) GROUP BY 1"""
)
def element_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "part").select(F.split("p_name", " ").alias("words"))
    return aggregates.count_elements(words, "words", "word")


@query(
    """SELECT p_type, array_to_string(list_sort(list_distinct(flatten(list(
       string_split(p_name, ' '))))), '|') AS words FROM part GROUP BY 1"""
)
def element_unions(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "part").select("p_type", F.split("p_name", " ").alias("words"))
    unions = aggregates.element_union(words, "words", ["p_type"])
    return unions.select("p_type", joined("words").alias("words"))


@query(
    """SELECT word, row_number() OVER (ORDER BY word) - 1 AS position
       FROM (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS word FROM part)"""
)
def element_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.distinct_elements(table(spark, sf_dir, "part"), F.split("p_name", " "), "word")


@query(
    """SELECT p_type, word, row_number() OVER (PARTITION BY p_type ORDER BY word) - 1 AS position
       FROM (SELECT DISTINCT p_type, unnest(string_split(p_name, ' ')) AS word FROM part)"""
)
def element_positions_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    return aggregates.distinct_elements(parts, F.split("p_name", " "), "word", ["p_type"])


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.count_by(table(spark, sf_dir, "events"), "event_type")


@query(
    "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS "column", CAST(b AS BIGINT) AS bin, round(lo + b * (hi - lo) / 30, 6)
            AS lower, round(lo + (b + 1) * (hi - lo) / 30, 6) AS upper, coalesce(n, 0) AS n
        FROM (SELECT min({c}) AS lo, max({c}) AS hi FROM lineitem),
             (SELECT unnest(range(30)) AS b)
        LEFT JOIN (SELECT least(floor(({c} - l) / (h - l) * 30), 29) AS bin, count(*) AS n
                   FROM lineitem, (SELECT min({c}) AS l, max({c}) AS h FROM lineitem) GROUP BY 1)
               ON bin = b"""
        for c in ("l_extendedprice", "l_quantity")
    )
)
def histogram_30(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    return rounded(aggregates.histograms(items, ["l_extendedprice", "l_quantity"], 30))


@query(
    """SELECT o_orderpriority, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
              o_totalprice FROM orders"""
)
def series_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    points = aggregates.series(orders, "o_orderdate", "o_totalprice", "o_orderpriority", True)
    return points.withColumn("o_orderdate", time_text("o_orderdate"))


@query(
    f"""WITH {SENSORS} SELECT scenario, count(*) AS n, {", ".join(
        f"round(avg({c}), 6) AS avg_{c}, round(min({c}), 6) AS min_{c}, "
        f"round(max({c}), 6) AS max_{c}" for c in ("soil_ph", "moisture", "q_value"))}
    FROM sensors GROUP BY 1"""
)
def summary_by_scenario(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["soil_ph", "moisture", "q_value"]
    return rounded(aggregates.summarise(sensors(spark, sf_dir), columns, ["scenario"]))


@query(
    f"""WITH {SENSORS} SELECT count(DISTINCT field_id) AS n_fields,
       array_to_string(list_sort(list(DISTINCT field_id)), '|') AS fields,
       bool_or(moisture IS NULL) AS any_gap, bool_and(moisture IS NULL) AS all_gap FROM sensors"""
)
def distinct_and_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = sensors(spark, sf_dir)
    fields = aggregates.distinct_values(readings, "field_id").agg(F.array_sort(F.collect_list("field_id")).alias("fields"))
    return aggregates.holds(readings, F.col("moisture").isNull()).select(
        aggregates.distinct_count(readings, "field_id").scalar().alias("n_fields"),
        joined(fields.scalar()).alias("fields"),
        F.col("any").alias("any_gap"),
        F.col("all").alias("all_gap"),
    )


@query(
    f"""WITH {SENSORS} SELECT event_id, '{{"timestamp":"' ||
      strftime("timestamp", '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond("timestamp") % 1000000 = 0
      THEN '' ELSE strftime("timestamp", '.%f') END || 'Z","field_id":"' || field_id || '"' ||
      {" || ".join(f"',{chr(34)}{c}{chr(34)}:' || coalesce('{chr(34)}' || " + _DEC.format(c)
                   + f" || '{chr(34)}', 'null')"
                   for c in JSON_FIELDS[2:])} || '}}' AS content FROM sensors"""
)
def reading_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = sensors(spark, sf_dir)
    return readings.select("event_id", row_json(readings, JSON_FIELDS, 6).alias("content"))


@query(
    f"""WITH {SENSORS}, advised AS (SELECT *, concat_ws('; ',
      CASE WHEN soil_ph < 5.5 THEN 'apply lime'
           WHEN soil_ph > 7.5 THEN 'apply elemental sulphur' END,
      CASE WHEN nitrogen < 10 THEN 'apply nitrogen'
           WHEN nitrogen > 60 THEN 'hold back nitrogen' END,
      CASE WHEN potassium < 8 THEN 'apply potash'
           WHEN potassium > 60 THEN 'hold back potash' END,
      CASE WHEN moisture < 20 THEN 'irrigate'
           WHEN moisture > 60 THEN 'improve drainage' END) AS advice FROM sensors)
    SELECT event_id, CASE WHEN advice = '' THEN 'keep current treatment' ELSE advice END
           AS recommendation FROM advised"""
)
def recommendation_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_recommendation(sensors(spark, sf_dir)).select("event_id", "recommendation")


@query(
    f"""WITH {SENSORS} SELECT event_id, field_id, strftime("timestamp", '%Y-%m-%d %H:%M:%S')
    AS "timestamp" FROM sensors ORDER BY sensors."timestamp", event_id LIMIT 10"""
)
def head_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = top_n(sensors(spark, sf_dir), [F.asc("timestamp"), F.asc("event_id")], 10)
    return first.select("event_id", "field_id", time_text("timestamp").alias("timestamp"))


@query(
    """SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS position
       FROM conversations"""
)
def position_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    numbered = number_within(turns, ["conv_id"], "turn", "position")
    return numbered.select("conv_id", "turn", "position")


@query(
    """SELECT l_orderkey, l_linenumber, l_returnflag,
         row_number() OVER (PARTITION BY l_returnflag
           ORDER BY CAST(l_orderkey AS BIGINT) * 16 + l_linenumber) - 1 AS position
       FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem)"""
)
def position_within_large_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three groups of a third of the table each, every one shared by many tasks."""
    items = distinct_rows(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber", "l_returnflag"])
    keyed = items.withColumn("order", F.col("l_orderkey") * 16 + F.col("l_linenumber"))
    return number_within(keyed, ["l_returnflag"], "order", "position").drop("order")


@query(
    """SELECT DISTINCT * FROM (
         SELECT c_nationkey AS nationkey, c_mktsegment AS segment, NULL AS supplier FROM customer
         UNION ALL SELECT s_nationkey, NULL, s_name FROM supplier)"""
)
def union_missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("nationkey"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("nationkey"), F.col("s_name").alias("supplier")
    )
    return distinct_rows(union_by_name(customers, suppliers))


@query(
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || 'Z' AS iso,
         CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS "day",
         CAST(epoch(o_orderdate) AS BIGINT) AS seconds,
         strftime(to_timestamp(floor(epoch(o_orderdate) / 900) * 900) AT TIME ZONE 'UTC',
                  '%Y-%m-%d %H:%M:%S') AS quarter,
         CAST(('0b' || bin(o_custkey))::BIGINT AS BIGINT) AS from_bits,
         'Order Status' AS title, '["' || o_orderstatus || '","' || o_orderpriority || '"]' AS tags
       FROM orders"""
)
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    date = F.col("o_orderdate")
    return orders.select(
        "o_orderkey",
        iso_text(date).alias("iso"),
        F.to_date(date).cast("string").alias("day"),
        epoch_seconds(date).alias("seconds"),
        time_text(floor_window(date)).alias("quarter"),
        binary_to_long(F.bin("o_custkey")).alias("from_bits"),
        title_words(F.lit("order_status")).alias("title"),
        F.to_json(F.array("o_orderstatus", "o_orderpriority")).alias("tags"),
    )


_PROFILED = [
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
    ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
    ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
    ("l_linestatus", "string"), ("l_shipdate", "timestamp"),
]


@query(
    "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS "column", '{kind}' AS "type", count(*) AS "rows",
        count(*) - count({c}) AS "nulls", CAST(min({c}){zero} AS VARCHAR)
        AS "min", CAST(max({c}){zero} AS VARCHAR) AS "max" FROM lineitem"""
        for c, kind in _PROFILED
        for zero in (" + 0.0::DOUBLE" if kind == "double" else "",)
    )
)
def profile_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile(table(spark, sf_dir, "lineitem"))


_DAY_COUNTS = f"""WITH {SENSORS}, {GATED}
SELECT CAST(CAST("timestamp" AS DATE) AS VARCHAR) AS "day", field_id, count(*) AS n,
       round(avg(soil_ph), 6) AS soil_ph FROM gated GROUP BY 1, 2"""


@query(_DAY_COUNTS)
def load_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load, partitioned by day and sorted by field, and read back."""
    path = load_readings(sensors(spark, sf_dir), scratch_path(spark, "readings"))
    stored = spark.read.parquet(path)
    return _per_day(stored.withColumn("day", F.col("day").cast("string")))


@query(_DAY_COUNTS)
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    gated = quality.gate(sensors(spark, sf_dir))
    path = write_csv(gated, scratch_path(spark, "csv"))
    stored = spark.read.schema(gated.schema).option("header", True).csv(path)
    return _per_day(stored.withColumn("day", F.to_date("timestamp").cast("string")))


def _per_day(readings: DataFrame) -> DataFrame:
    grouped = readings.groupBy("day", "field_id")
    return rounded(grouped.agg(F.count(F.lit(1)).alias("n"), F.avg("soil_ph").alias("soil_ph")))


@query(
    f"""WITH {SENSORS} SELECT field_id, count(*) AS n FROM sensors
    WHERE NOT ({COMPLETE_SQL}) GROUP BY 1"""
)
def stored_incomplete_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table created from a query, read back."""
    rest = quality.keep_incomplete(sensors(spark, sf_dir))
    path = replace_parquet(aggregates.count_by(rest, "field_id"), scratch_path(spark, "table"))
    return spark.read.parquet(path)


# The spellings of the query below, by the order's key.
_SPELLINGS = (
    "yyyy-MM-dd", "yyyy/MM/dd", "MM/dd/yyyy", "d MMM yyyy", "d MMMM yyyy", "yyyyMMdd", "MMM d, yyyy", "dd.MM.yyyy",
)


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d 00:00:00') AS day FROM orders")
def mixed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates written in eight ways, read back."""
    orders = table(spark, sf_dir, "orders")
    text = F.lit(None).cast("string")
    for number, pattern in enumerate(_SPELLINGS):
        chosen = F.col("o_orderkey") % len(_SPELLINGS) == number
        text = F.when(chosen, F.date_format("o_orderdate", pattern)).otherwise(text)
    return orders.select("o_orderkey", time_text(parse_timestamp(text)).alias("day"))


@query(
    """SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderpriority
       ORDER BY CAST(o_orderdate AS DATE), o_orderkey) - 1 AS "position" FROM orders"""
)
def position_with_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many orders share a day; the key breaks the tie."""
    days = F.unix_date(F.to_date("o_orderdate"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", days.alias("day"))
    return number_within(orders, ["o_orderpriority"], ["day", "o_orderkey"], "position").select("o_orderkey", "position")


@query(
    """WITH records AS (SELECT l_orderkey, l_linenumber, l_returnflag, l_shipdate, concat(
           len(l_orderkey::VARCHAR), ':', l_orderkey::VARCHAR, len(l_linenumber::VARCHAR), ':', l_linenumber::VARCHAR,
           coalesce(len(l_returnflag) || ':' || l_returnflag, '-'),
           '19:', strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')) AS written FROM
           (SELECT l_orderkey, l_linenumber, nullif(l_returnflag, 'A') AS l_returnflag, l_shipdate FROM lineitem))
       SELECT l_orderkey, l_linenumber, CAST(row_number() OVER (ORDER BY md5(written)) - 1 AS VARCHAR) AS field_id FROM records"""
)
def row_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense ids of records without coordinates, whatever the files and partitions."""
    records = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.expr("nullif(l_returnflag, 'A')").alias("l_returnflag"), "l_shipdate"
    )
    return with_row_id(records).select("l_orderkey", "l_linenumber", "field_id")
