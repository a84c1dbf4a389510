"""Forecasts, fits, importance, attributions, KS test and what-if comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlake.operators import stats
from fieldlake.operators.forecast import forecast, forecast_summary
from fieldlake.operators.quality import drop_nulls, keep_category
from fieldlake.operators.whatif import stress_test
from workload.registry import query, rounded, time_text
from workload.views import SENSORS, clamp_sql, sensors, table

FORECAST = """
daily AS (SELECT event_type, CAST(ts AS DATE) AS "day", avg(value) AS y FROM events GROUP BY 1, 2),
recent AS (SELECT *, date_diff('day', DATE '1970-01-01', "day") AS x FROM daily
  QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY "day" DESC) <= 30),
fit AS (SELECT event_type, count(*) AS n, max("day") AS last_day, avg(x) AS xm, avg(y) AS ym,
  regr_sxx(y, x) AS sxx, regr_sxy(y, x) AS sxy, regr_syy(y, x) AS syy FROM recent GROUP BY 1),
steps AS (SELECT *, last_day + CAST(h AS INTEGER) AS "day",
  date_diff('day', DATE '1970-01-01', last_day + CAST(h AS INTEGER)) - xm AS dist,
  sxy / sxx AS b, sqrt(greatest(syy - sxy / sxx * sxy, 0) / (n - 2)) AS s
  FROM fit, (SELECT unnest(range(1, 15)) AS h)),
forecasts AS (SELECT event_type, "day", ym + b * dist AS v,
  1.96 * s * sqrt(1 + 1.0 / n + dist * dist / sxx) AS half FROM steps)
"""


def _forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast(table(spark, sf_dir, "events"), ["event_type"], "ts", "value")


@query(
    f"""WITH {FORECAST} SELECT event_type, strftime("day", '%Y-%m-%d %H:%M:%S')
    AS forecast_timestamp, round(v, 6) AS forecast_value,
    round(v - half, 6) AS confidence_interval_lower,
    round(v + half, 6) AS confidence_interval_upper FROM forecasts"""
)
def forecast_14d(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _forecasts(spark, sf_dir)
    return rounded(out.withColumn("forecast_timestamp", time_text("forecast_timestamp")))


@query(
    f"""WITH {FORECAST} SELECT event_type, round(avg(v), 6) AS forecast_value,
    round(avg(v - half), 6) AS confidence_interval_lower,
    round(avg(v + half), 6) AS confidence_interval_upper FROM forecasts GROUP BY 1"""
)
def forecast_by_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(forecast_summary(_forecasts(spark, sf_dir), ["event_type"]))


@query(
    """SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 6) AS coef,
      round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept,
      round(regr_r2(l_extendedprice, l_quantity), 6) AS r2, count(*) AS n
      FROM lineitem GROUP BY 1"""
)
def linear_fit_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    return rounded(stats.linear_fit(items, "l_quantity", "l_extendedprice", ["l_returnflag"]))


@query(
    """SELECT 'fitted' AS status, 0.0::DOUBLE AS coef, round(avg(l_extendedprice), 6) AS intercept,
              0.0::DOUBLE AS r2, count(*) AS n FROM lineitem"""
)
def model_summary_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A constant regressor has slope 0 and the mean as intercept."""
    items = table(spark, sf_dir, "lineitem").withColumn("moisture", F.lit(30.0))
    fit = stats.linear_fit(items, "moisture", "l_extendedprice")
    return rounded(stats.model_summary(fit, items))


_CORR = """
c AS (SELECT corr(l_extendedprice, l_quantity) AS ra, corr(l_extendedprice, l_discount) AS rb,
  corr(l_quantity, l_discount) AS rab, stddev_pop(l_extendedprice) AS sy,
  stddev_pop(l_quantity) AS sa, stddev_pop(l_discount) AS sb, avg(l_extendedprice) AS my,
  avg(l_quantity) AS ma, avg(l_discount) AS mb FROM lineitem),
m AS (SELECT *, (ra - rb * rab) / (1 - rab * rab) AS ba, (rb - ra * rab) / (1 - rab * rab) AS bb
      FROM c)
"""
_FEATURES = ["l_quantity", "l_discount"]


@query(
    f"""WITH {_CORR}, r AS (SELECT *, ba * ra + bb * rb AS r2 FROM m)
    SELECT 'l_quantity' AS feature, round(greatest(0, r2 - rb * rb), 9) AS importance FROM r
    UNION ALL SELECT 'l_discount', round(greatest(0, r2 - ra * ra), 9) FROM r"""
)
def leave_one_out_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    found = stats.leave_one_out_importance(items, "l_extendedprice", _FEATURES)
    return rounded(found, 9)


@query(
    f"""WITH {_CORR}
    SELECT l_orderkey, l_linenumber, round(ba * sy / sa * (l_quantity - ma), 4) + 0.0
      AS attribution_l_quantity,
      round(bb * sy / sb * (l_discount - mb), 4) + 0.0 AS attribution_l_discount,
      round(my, 4) AS baseline,
      round(my + ba * sy / sa * (l_quantity - ma) + bb * sy / sb * (l_discount - mb), 4)
        AS prediction
    FROM lineitem, m"""
)
def linear_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", *_FEATURES
    )
    explained = stats.attributions(items, _FEATURES, "l_extendedprice")
    return rounded(explained.drop("l_extendedprice", *_FEATURES), 4)


_KS = """
v AS (SELECT value AS x, CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS a,
             CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS b
      FROM events WHERE event_type IN ('click', 'view')),
t AS (SELECT CAST(sum(a) AS BIGINT) AS n1, CAST(sum(b) AS BIGINT) AS n2 FROM v),
g AS (SELECT x, sum(a) AS a, sum(b) AS b FROM v GROUP BY 1),
w AS (SELECT CAST(sum(a) OVER (ORDER BY x) AS DOUBLE) AS ca,
             CAST(sum(b) OVER (ORDER BY x) AS DOUBLE) AS cb FROM g),
d AS (SELECT max(abs(ca / n1 - cb / n2)) AS d, any_value(n1) AS n1, any_value(n2) AS n2 FROM w, t),
l AS (SELECT *, sqrt(CAST(n1 * n2 AS DOUBLE) / (n1 + n2)) * d AS z FROM d)
"""


@query(
    f"""WITH {_KS} SELECT round(d, 9) AS d, n1, n2, round(CASE WHEN z < 0.2 THEN 1.0 ELSE
      greatest(0, least(1, list_sum(list_transform(range(1, 101), lambda k:
        CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END * exp(-2.0 * k * k * z * z))))) END, 9)
      AS p_value FROM l"""
)
def ks_two_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks against views; the asymptotic p-value, which SQL can express."""
    values = drop_nulls(table(spark, sf_dir, "events").select("event_type", "value"), ["value"])
    clicks = keep_category(values, "event_type", "click")
    views = keep_category(values, "event_type", "view")
    return rounded(stats.ks_test(clicks, views, "value"), 9)


@query(
    f"""WITH {SENSORS}, base AS ({clamp_sql("sensors")}),
    dry AS ({clamp_sql('''(SELECT * REPLACE (greatest(moisture * 0.5, 0) AS moisture,
              temperature + 4 AS temperature) FROM (SELECT *, FROM sensors WHERE moisture IS NOT NULL)
              UNION ALL BY NAME SELECT * REPLACE (temperature + 4 AS temperature) FROM sensors
              WHERE moisture IS NULL)''')}),
    means AS (SELECT 0 AS s, avg(moisture) AS m, avg(temperature) AS t, avg(soil_ph) AS p FROM base
              UNION ALL SELECT 1, avg(moisture), avg(temperature), avg(soil_ph) FROM dry),
    rows_ AS (SELECT metric, max(v) FILTER (s = 0) AS b, max(v) FILTER (s = 1) AS d FROM (
      SELECT s, unnest(['avg_moisture', 'avg_temperature', 'avg_ph']) AS metric,
             unnest([m, t, p]) AS v FROM means) GROUP BY 1)
    SELECT metric, round(b, 6) AS baseline, round(d, 6) AS drought, round(d - b, 6) + 0.0 AS delta
    FROM rows_"""
)
def stress_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(stress_test(sensors(spark, sf_dir)))
