import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldlake.operators import ranges, stats, whatif
from fieldlake.operators.forecast import forecast, forecast_summary
from fieldlake.schema import READING


def numbers(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "v double").repartition(4)


def ks_statistic(a, b):
    a, b = np.sort(a), np.sort(b)
    points = np.concatenate([a, b])
    return np.abs(
        np.searchsorted(a, points, "right") / len(a) - np.searchsorted(b, points, "right") / len(b)
    ).max()


@pytest.mark.parametrize("size", [1_000_000, 90, 5])
@pytest.mark.parametrize("kind", ["smooth", "skewed", "constant"])
def test_ks_statistic(spark, size, kind, monkeypatch):
    monkeypatch.setattr(ranges, "RANGE_ROWS", size)
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=400), rng.normal(0.2, 1.2, size=300)
    if kind == "skewed":  # a third of all values are the same
        a[:150], b[:80] = 0.25, 0.25
    if kind == "constant":
        a[:], b[:] = 1.0, 1.0
    row = stats.ks_test(numbers(spark, a), numbers(spark, b), "v").first()
    assert row["d"] == pytest.approx(ks_statistic(a, b), abs=1e-12)
    assert (row["n1"], row["n2"]) == (400, 300)
    assert 0 <= row["p_value"] <= 1


def test_large_samples(spark):
    a = spark.range(200_000).select(F.rand(1).alias("v"))
    b = spark.range(150_000).select(F.rand(2).alias("v"))
    assert 0 < stats.ks_test(a, b, "v").first()["p_value"] <= 1


def test_ks_of_an_empty_side(spark):
    row = stats.ks_test(numbers(spark, [1.0]), numbers(spark, [float("nan")]), "v").first()
    assert (row["p_value"], row["n1"], row["n2"]) == (0.0, 1, 0)
    none = numbers(spark, [float("nan")])
    assert stats.ks_test(none, none, "v").first()["p_value"] == 0.0


def test_ks_of_equal_samples(spark):
    row = stats.ks_test(numbers(spark, [1.0, 2.0]), numbers(spark, [1.0, 2.0]), "v").first()
    assert (row["d"], row["p_value"]) == (0.0, 1.0)


def r_squared(x, y):
    x = np.column_stack([np.ones(len(y)), x]) if x.size else np.ones((len(y), 1))
    rest = y - x @ np.linalg.lstsq(x, y, rcond=None)[0]
    return 1 - (rest @ rest) / ((y - y.mean()) @ (y - y.mean()))


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(300, 3))
    data = np.column_stack([x, x[:, 0] * 1e-6, x @ [2.0, 0.0, -1.0] + rng.normal(size=300)])
    rows = [tuple(map(float, r)) for r in data]
    df = spark.createDataFrame(rows, "a double, b double, c double, a_small double, y double")
    return data, df.withColumn("label", F.lit("text"))


def test_importance_like_refits(table):
    data, df = table
    names = ["a", "b", "c"]
    found = stats.leave_one_out_importance(df.drop("a_small"), "y").collect()
    assert [r["feature"] for r in found][:2] == ["a", "c"] and len(found) == 3
    full = r_squared(data[:, :3], data[:, 4])
    for row in found:
        rest = [i for i, n in enumerate(names) if n != row["feature"]]
        want = max(0.0, full - r_squared(data[:, rest], data[:, 4]))
        assert row["importance"] == pytest.approx(want, abs=1e-9)


def test_collinear_and_single_and_no_features(table):
    data, df = table
    twins = {r["feature"]: r["importance"] for r in
             stats.leave_one_out_importance(df, "y", ["a", "a_small", "c"]).collect()}
    assert twins["a"] == pytest.approx(0, abs=1e-9) == twins["a_small"] and twins["c"] > 0.05
    one = stats.leave_one_out_importance(df, "y", ["a"]).first()
    assert one["importance"] == pytest.approx(r_squared(data[:, :1], data[:, 4]))
    assert stats.leave_one_out_importance(df, "y", ["label"]).count() == 0
    flat = df.withColumn("y", F.lit(1.0))
    assert {r["importance"] for r in stats.leave_one_out_importance(flat, "y").collect()} == {0.0}


def test_attributions_add_up(table):
    data, df = table
    names = ["a", "b", "c"]
    rows = stats.attributions(df, names, "y").collect()
    x = np.column_stack([np.ones(300), data[:, :3]])
    fit = x @ np.linalg.lstsq(x, data[:, 4], rcond=None)[0]
    assert sorted(r["prediction"] for r in rows) == pytest.approx(sorted(fit))
    row = rows[0]
    parts = sum(row[f"attribution_{n}"] for n in names)
    assert row["baseline"] + parts == pytest.approx(row["prediction"])


def test_fit_of_missing_targets(spark):
    df = spark.createDataFrame(
        [(1.0, "2"), (2.0, "4"), (3.0, "junk"), (None, "9")], "moisture double, crop_yield string"
    )
    drop = stats.linear_fit(df, "moisture", "crop_yield").first()
    assert (drop["coef"], drop["n"], drop["r2"]) == (2.0, 2, 1.0)
    zero = stats.fit_yield(df).first()
    assert (zero["coef"], zero["n"]) == (-1.0, 3)
    with pytest.raises(ValueError):
        stats.linear_fit(df, "moisture", "crop_yield", missing_target="mean")


def test_fit_per_group_and_degenerate(spark):
    df = spark.createDataFrame(
        [("u", 1.0, 5.0), ("u", 1.0, 7.0), ("v", 1.0, 3.0), ("v", 2.0, 3.0)], "g string, x double, y double"
    )
    out = {r["g"]: (r["coef"], r["intercept"], r["r2"]) for r in stats.linear_fit(df, "x", "y", ["g"]).collect()}
    assert out == {"u": (0.0, 6.0, 0.0), "v": (0.0, 3.0, 1.0)}


def test_forecast_of_short_and_gappy_series(spark):
    rows = [("two", "2024-01-01", 1.0), ("two", "2024-01-02", 3.0)]
    rows += [("gaps", f"2024-01-{d:02d}", float(d)) for d in (1, 2, 5, 9, 10)]
    rows += [("gaps", "2024-01-10", 10.0), ("gaps", None, 99.0), ("gaps", "2024-01-12", None)]
    df = spark.createDataFrame(rows, "s string, t string, yield double")
    df = df.withColumn("timestamp", F.to_timestamp("t"))
    out = forecast(df, ["s"], horizon=3)
    two = out.filter("s = 'two'").orderBy("forecast_timestamp").collect()
    assert [r["forecast_value"] for r in two] == [2.0, 2.0, 2.0]
    assert all(r["confidence_interval_lower"] is None for r in two)
    gaps = out.filter("s = 'gaps'").orderBy("forecast_timestamp").collect()
    assert [r["forecast_value"] for r in gaps] == pytest.approx([11.0, 12.0, 13.0])
    assert str(gaps[0]["forecast_timestamp"]) == "2024-01-11 00:00:00"
    assert all(r["confidence_interval_upper"] >= r["forecast_value"] - 1e-9 for r in gaps)
    assert forecast_summary(out.filter("s = 'gaps'")).first()["forecast_value"] == pytest.approx(12.0)


def test_forecast_interval_by_hand(spark):
    y = [3.0, 5.0, 4.0, 8.0]
    df = spark.createDataFrame(
        [(f"2024-01-0{i + 1}", v) for i, v in enumerate(y)], "t string, yield double"
    ).withColumn("timestamp", F.to_timestamp("t"))
    row = forecast(df, [], horizon=1).first()
    x = np.arange(4.0)
    b, a = np.polyfit(x, y, 1)
    s = math.sqrt(((np.array(y) - a - b * x) ** 2).sum() / 2)
    half = 1.96 * s * math.sqrt(1 + 1 / 4 + (4 - 1.5) ** 2 / 5)
    assert row["forecast_value"] == pytest.approx(a + 4 * b)
    assert row["confidence_interval_upper"] - row["forecast_value"] == pytest.approx(half)


def test_lookback_uses_the_last_observed_days(spark):
    df = spark.range(40).select(
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).cast("timestamp").alias("timestamp"),
        F.when(F.col("id") < 30, 100.0).otherwise(F.col("id") * 1.0).alias("yield"),
    )
    assert forecast(df, [], lookback=10, horizon=1).first()["forecast_value"] == pytest.approx(40.0)


def test_stress(spark):
    rows = [(None, "f", 6.0, 1.0, 1.0, 1.0, m, t, "s", 0.5) for m, t in [(40.0, 58.0), (20.0, 10.0)]]
    df = spark.createDataFrame(rows, READING)
    out = {r["metric"]: (r["baseline"], r["drought"], r["delta"]) for r in whatif.stress_test(df).collect()}
    assert out == {
        "avg_moisture": (30.0, 15.0, -15.0),
        "avg_temperature": (34.0, 37.0, 3.0),
        "avg_ph": (6.0, 6.0, 0.0),
    }


def test_importance_of_many_columns(spark, plan_of):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(700, 60)) * 10.0 ** rng.integers(-3, 6, 60) + 1e4
    x[:, 7] = x[:, 3] * 2 - x[:, 5] / 3  # made up by others
    y = x[:, :20] @ rng.normal(size=20) / 1e3 + rng.normal(size=700)
    names = [f"x{i:02d}" for i in range(60)]
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], ", ".join(f"{n} double" for n in [*names, "y"]))
    found = stats.leave_one_out_importance(df.repartition(5), "y")
    got = {r["feature"]: r["importance"] for r in found.collect()}
    assert len(got) == 60 and plan_of(found).count("covar") == 0
    scaled = (x - x.mean(axis=0)) / x.std(axis=0)
    full = r_squared(scaled, y)
    for i in (0, 3, 5, 7, 19, 20, 59):
        rest = [j for j in range(60) if j != i]
        assert got[f"x{i:02d}"] == pytest.approx(max(0.0, full - r_squared(scaled[:, rest], y)), abs=1e-8)
    model = stats.linear_model(df, names, "y").first()
    assert model["r2"] == pytest.approx(full, abs=1e-8)
