"""Synthetic readings for the rows of ``events``: as many as there are events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlake.functions.temporal import floor_window
from fieldlake.operators.rows import union_by_name
from fieldlake.operators.whatif import compare_ablation
from fieldlake.sources.generator import SCENARIOS, time_grid, with_readings, without_coherence
from workload.registry import query, rounded, time_text
from workload.views import table

_U = "((('0x' || substr(noise, {0}, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)"


def _normal(i: int) -> str:
    first, second = _U.format(16 * (i // 2) + 1), _U.format(16 * (i // 2) + 9)
    turn = "cos" if i % 2 == 0 else "sin"
    return f"(sqrt(-2 * ln({first})) * {turn}(2 * pi() * {second}))"


GENERATED = f"""
slots AS (
  SELECT event_id, scenario, CAST(floor(epoch(ts) / 900) AS BIGINT) AS w
  FROM (SELECT event_id, ts, 'soil_chemistry' AS scenario FROM events)),
draws AS (
  SELECT *, sha256(CAST(42 + w * 1000 + event_id AS VARCHAR)) AS noise,
    list_sum(list_transform(string_split(
      translate(sha256(w || ':0'), '0123456789abcdef', '0123456701234567'), ''),
      lambda d: CAST(d AS BIGINT))) / 448.0::DOUBLE AS q
  FROM slots),
generated AS (
  SELECT event_id, to_timestamp(w * 900) AT TIME ZONE 'UTC' AS "timestamp",
    'field_' || (event_id % 5 + 1) AS field_id, scenario, q AS q_value,
    round(greatest(3.5::DOUBLE, least(9::DOUBLE, 6.5 + (q - 0.5) * 0.6)), 3) AS soil_ph,
    round(greatest(0::DOUBLE, least(100::DOUBLE, 10 + q * 2 + {_normal(0)} * 1.5)), 3) AS nitrogen,
    round(greatest(0::DOUBLE, least(50::DOUBLE, 5 + q * 1.2 + {_normal(1)})), 3) AS phosphorus,
    round(greatest(0::DOUBLE, least(100::DOUBLE, 8 + q * 1.4 + {_normal(2)} * 1.2)), 3)
      AS potassium,
    round(greatest(0::DOUBLE, least(100::DOUBLE, 30 + q * 5 + {_normal(3)} * 5)), 3) AS moisture,
    round(17 + q * 6 + {_normal(4)} * 2.5, 3) AS temperature
  FROM draws)
"""

_COLUMNS = "soil_ph, nitrogen, phosphorus, potassium, moisture, temperature"


@query(
    f"""WITH {GENERATED} SELECT strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp",
    field_id, scenario, round(q_value, 6) AS q_value, {_COLUMNS} FROM generated"""
)
def generated_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    made = with_readings(events, F.col("event_id"), floor_window(F.col("ts")))
    return rounded(made.withColumn("timestamp", time_text("timestamp")))


@query(
    """SELECT event_id, strftime(to_timestamp(
         floor(epoch((SELECT max(ts) FROM events)) / 900) * 900
         - ((SELECT count(*) FROM events) - 1 - event_id) * 900) AT TIME ZONE 'UTC',
         '%Y-%m-%d %H:%M:%S') AS "timestamp",
         'field_' || (event_id % 3 + 1) AS field_id FROM events"""
)
def generated_time_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A regular grid with one step per event, ending at the last event."""
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    count = events.agg(F.count(F.lit(1))).scalar()
    end = events.agg(F.max("ts")).scalar()
    grid = time_grid(F.col("event_id"), count, end)
    return events.select(
        "event_id",
        time_text(grid).alias("timestamp"),
        F.concat(F.lit("field_"), F.col("event_id") % 3 + 1).alias("field_id"),
    )


@query(
    f"""WITH {GENERATED}
    SELECT s AS scenario, count(*) AS n, round(avg(q_value), 6) AS q_value,
           round(avg(moisture), 6) AS moisture
    FROM generated, (SELECT unnest({SCENARIOS}) AS s) GROUP BY 1"""
)
def generated_scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same readings under each label, exploded in place."""
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    labelled = events.withColumn("scenario", F.explode(F.array(*[F.lit(s) for s in SCENARIOS])))
    made = with_readings(
        labelled, F.col("event_id"), floor_window(F.col("ts")), scenario=F.col("scenario")
    )
    return rounded(
        made.groupBy("scenario").agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("q_value").alias("q_value"),
            F.avg("moisture").alias("moisture"),
        )
    )


@query(
    f"""WITH {GENERATED}
    SELECT run, count(*) AS n, round(avg(CASE WHEN run = 'ablated' THEN 0.5 ELSE q_value END), 6)
      AS avg_q_value,
      count(*) FILTER ((CASE WHEN run = 'ablated' THEN 0.5 ELSE q_value END) > 0.7) AS n_high,
      min(soil_ph) AS min_ph, max(soil_ph) AS max_ph,
      min(nitrogen) AS min_nitrogen, max(nitrogen) AS max_nitrogen
    FROM generated, (SELECT unnest(['coherent', 'ablated']) AS run) GROUP BY 1"""
)
def ablation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    made = with_readings(events, F.col("event_id"), floor_window(F.col("ts")))
    runs = union_by_name(
        made.withColumn("run", F.lit("coherent")),
        without_coherence(made).withColumn("run", F.lit("ablated")),
    )
    return rounded(compare_ablation(runs))
