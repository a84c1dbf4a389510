from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fieldlake.operators import aggregates, enrich, mapping, ranges, rows, stats
from fieldlake.plans.integration import INTEGRATED, integrate, integrate_local, merge_datasets
from fieldlake.sources.grids import moisture_grid
from workload import enrichment

NAN = float("nan")


def day(year, month=1, d=1):
    return datetime(year, month, d)


@pytest.fixture(scope="module")
def grid(spark):
    cells = [
        (day(2000, 1, 5), 1.0, 1.0, 10.0), (day(2000, 1, 5), 2.0, 1.0, 20.0),
        (day(2000, 1, 20), 1.0, 1.0, 40.0), (day(2000, 1, 20), 2.0, 1.0, NAN),
        (day(2000, 4, 1), 1.0, 1.0, 70.0),
        (day(2001, 1, 1), 1.0, 1.0, NAN),
        (day(2003, 6, 1), 2.0, 1.0, 50.0),
    ]
    df = spark.createDataFrame(cells, "time timestamp, lat double, lon double, soil_moisture double")
    return moisture_grid(df)


def by_year(df):
    return {r["year"]: r["moisture"] for r in df.collect()}


def test_mean_of_steps_and_of_cell_months_differ(grid):
    steps = by_year(enrich.annual_moisture(grid, "step_mean"))
    cells = by_year(enrich.annual_moisture(grid, "cell_month"))
    assert steps == {2000: (15 + 40 + 70) / 3, 2001: None, 2002: None, 2003: 50.0}
    assert cells == {2000: (25 + 20 + 70) / 3, 2001: None, 2003: 50.0}
    with pytest.raises(ValueError):
        enrich.annual_moisture(grid, "other")


def test_dense_months_cover_the_span_for_every_cell(grid):
    out = enrich.resample_mean(grid, "month", ["lat", "lon"])
    assert out.count() == 2 * 42
    found = {(r["lat"], str(r["period"])): r["soil_moisture"] for r in out.collect()}
    assert found[(1.0, "2000-01-01")] == 25.0 and found[(2.0, "2003-06-01")] == 50.0
    assert found[(1.0, "2003-06-01")] is None and found[(2.0, "2000-02-01")] is None
    ends = enrich.resample_mean(grid, "month", ["lat", "lon"], label_end=True)
    assert ends.filter("period = date'2000-02-29'").count() == 2


def soils(spark, data):
    return spark.createDataFrame(data, "id int, year int, moisture double, timestamp timestamp")


def test_join_prefers_the_grid_and_never_matches_unknown_years(spark):
    left = soils(spark, [(1, 2000, 5.0, None), (2, 2001, 5.0, None), (3, None, 5.0, None)])
    annual = spark.createDataFrame([(2000, 9.0), (2001, None), (None, 7.0)], "year int, moisture double")
    for unique in (True, False):
        out = {r["id"]: r["moisture"] for r in enrich.join_annual(left, annual, unique).collect()}
        assert out == {1: 9.0, 2: 5.0, 3: 5.0}


def test_two_values_for_a_year_fan_out(spark):
    left = soils(spark, [(1, 2000, None, None)])
    annual = spark.createDataFrame([(2000, 1.0), (2000, 2.0), (2000, 2.0)], "year int, moisture double")
    assert sorted(r["moisture"] for r in enrich.join_annual(left, annual).collect()) == [1.0, 2.0]


def test_fill_cascade(spark):
    left = soils(spark, [(1, 2000, 10.0, None), (2, 2000, 20.0, None), (3, 2000, None, None),
                         (4, 2001, None, None), (5, None, None, None), (6, None, 99.0, None)])
    out = {r["id"]: r["moisture"] for r in enrich.fill_moisture(left).collect()}
    assert out == {1: 10.0, 2: 20.0, 3: 15.0, 4: 30.0, 5: 30.0, 6: 99.0}


@pytest.mark.parametrize(
    "years, expand, expected",
    [
        ([None, None], None, 4), ([2000, 2000], None, 4), ([2000, None], None, 4),
        ([2000, 2001], None, 2), ([2000, 2001], True, 4), ([2000, 2000], False, 2),
    ],
)
def test_year_expansion(spark, years, expand, expected):
    left = soils(spark, [(i, y, None, day(y) if y else None) for i, y in enumerate(years)])
    annual = spark.createDataFrame([(1990, 1.0), (1991, None)], "year int, moisture double")
    out = enrich.expand_years(left, annual, expand).collect()
    assert len(out) == expected
    if expected == 4:
        assert {(r["year"], r["timestamp"]) for r in out} == {(1990, day(1990)), (1991, day(1991))}


def test_no_expansion_without_moisture_years(spark):
    left = soils(spark, [(1, None, None, None)])
    annual = spark.createDataFrame([], "year int, moisture double")
    assert [r["year"] for r in enrich.expand_years(left, annual).collect()] == [None]


def test_expansion_has_no_join(spark, plan_of):
    left = soils(spark, [(1, None, None, None)])
    annual = spark.createDataFrame([(1990, 1.0)], "year int, moisture double")
    assert "Join" not in plan_of(enrich.expand_years(left, annual))


def test_weather_fills_gaps_without_repeating_rows(spark):
    readings = spark.createDataFrame(
        [(1, 1.0001, 2.0, day(2024), None), (2, 1.0, 2.0, day(2024), 5.0), (3, 9.0, 9.0, day(2024), None)],
        "id int, lat double, lon double, timestamp timestamp, temperature double",
    )
    weather = spark.createDataFrame(
        [(1.0, 2.0, day(2024, 1, 1), 10.0), (1.0, 2.0, datetime(2024, 1, 1, 9), 20.0)],
        "lat double, lon double, date timestamp, temperature double",
    )
    out = {r["id"]: r["temperature"] for r in enrich.fill_temperature(readings, weather).collect()}
    assert out == {1: 15.0, 2: 5.0, 3: None}
    assert enrich.fill_temperature(readings) is readings


def test_integration_of_one_year_expands_and_fits_flat(spark, grid):
    raw = spark.createDataFrame(
        [("47.92", "-109.92", "1970", "6.1", "400", "22"), ("48.3", "-110.1", "1970", "bad", "9", "1")],
        "Latitude string, Longitude string, SamplingYear string, SoilpH string, N_C string, K_C string",
    ).withColumn("P_C", F.lit("7"))
    out = integrate(raw, grid)
    assert out.columns == INTEGRATED
    kept = out.orderBy("year").collect()
    assert [r["year"] for r in kept] == [2000, 2001, 2002, 2003]  # the row without pH is dropped
    assert [r["moisture"] for r in kept] == [125 / 3, 30.0, 30.0, 50.0]
    assert {(r["nitrogen"], r["temperature"], r["scenario"]) for r in kept} == {(100.0, 20.0, "real_world")}
    assert len({r["q_value"] for r in kept}) == 1
    flat = stats.linear_fit(out.withColumn("moisture", F.lit(30.0)), "moisture", "potassium").first()
    assert (flat["coef"], flat["intercept"], flat["r2"]) == (0.0, 22.0, 1.0)
    stored = integrate(raw, grid, store_mapped=True)
    assert stored.exceptAll(out).count() == 0


def test_local_pipeline_drops_empty_temperatures(spark, grid):
    raw = spark.createDataFrame(
        [("2000", "6.0", "1", "2", "3", "11"), ("2000", "6.0", "1", "2", "3", None), ("1999", "6.0", "1", "2", "3", "12")],
        "Year string, SoilpH string, N string, P string, K string, temperature string",
    )
    out = integrate_local(raw, grid).orderBy("year").collect()
    assert [(r["year"], r["moisture"], r["temperature"]) for r in out] == [
        (1999, 30.0, 12.0), (2000, (25 + 20 + 70) / 3, 11.0)]


def test_merge_accepts_a_timestamped_moisture_table(spark):
    left = spark.createDataFrame(
        [(day(2000), "f", 6.0, 1.0, 1.0, 1.0, None, None, 0.1), (day(2001), "f", 6.0, 1.0, 1.0, 1.0, 3.0, 4.0, 0.2)],
        "timestamp timestamp, field_id string, soil_ph double, nitrogen double, phosphorus double, "
        "potassium double, moisture double, temperature double, q_value double",
    )
    moisture = spark.createDataFrame([(day(2000), 12.0)], "timestamp timestamp, soil_moisture double")
    out = {r["year"]: (r["moisture"], r["temperature"]) for r in merge_datasets(left, moisture).collect()}
    assert out == {2000: (12.0, 20.0), 2001: (3.0, 4.0)}


def test_enrichment_keeps_the_big_side_in_place(spark, plan_of):
    left = soils(spark, [(1, 2000, None, None)])
    annual = spark.createDataFrame([(2000, 1.0)], "year int, moisture double")
    plan = plan_of(enrich.fill_moisture(enrich.join_annual(left, annual, True)))
    assert plan.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in plan


def test_histogram_edges_and_flat_columns(spark):
    df = spark.createDataFrame([(0.0, 7.0), (1.0, 7.0), (10.0, 7.0), (None, 7.0)], "x double, y double")
    out = aggregates.histograms(df, ["x", "y"], 10).collect()
    x = {r["bin"]: r["n"] for r in out if r["column"] == "x"}
    y = {r["bin"]: (r["lower"], r["n"]) for r in out if r["column"] == "y"}
    assert len(x) == 10 and (x[0], x[1], x[9]) == (1, 1, 1)
    assert y[0][0] == 6.5 and y[5][1] == 4
    assert aggregates.histograms(df.filter("x > 100"), ["x"], 10).count() == 0


def test_rows_helpers(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(2, 5)], "k int, v int")
    assert {tuple(r) for r in rows.union_by_name(a, b).collect()} == {(1, "x"), (2, "5")}
    c = spark.createDataFrame([(1, 2)], "k int, w int")
    assert {tuple(r) for r in rows.union_by_name(a, c).collect()} == {(1, "x", None), (1, None, 2)}
    lists = spark.createDataFrame([("g", ["b", "a"]), ("g", ["c", "a"])], "g string, e array<string>")
    assert aggregates.element_union(lists, "e", ["g"]).first()["e"] == ["a", "b", "c"]
    assert aggregates.indicator_matrix(lists, "g", "e").first().asDict() == {"g": "G", "a": 1, "b": 1, "c": 1}
    counts = {r["element"]: r["n"] for r in aggregates.count_elements(lists, "e").collect()}
    assert counts == {"a": 2, "b": 1, "c": 1}


def test_top_per_group_limits_before_the_shuffle(spark, plan_of):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    top = rows.top_per_group(df, ["g"], [F.desc("id")], 2)
    assert sorted(r["id"] for r in top.collect()) == [94, 95, 96, 97, 98, 99]
    assert "WindowGroupLimit" in plan_of(top)
    assert "TakeOrderedAndProject" in plan_of(rows.top_n(df, [F.desc("id")], 3))


def test_aggregate_helpers(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), (None, 5.0)], "k string, v double")
    assert {r["k"] for r in aggregates.mean_by(df, ["k"], ["v"]).collect()} == {"a", "b"}
    assert aggregates.distinct_count(df, "k").first()[0] == 2
    assert aggregates.distinct_count(df, "k", approximate=True).first()[0] == 2
    assert [r["k"] for r in aggregates.distinct_values(df, "k").collect()] == ["a", "b"]
    flags = aggregates.holds(df, F.col("v") > 2).first()
    assert flags["any"] and not flags["all"]


@pytest.mark.parametrize("size", [1_000_000, 70, 8])
def test_positions_in_a_dominant_group(spark, size, monkeypatch):
    monkeypatch.setattr(ranges, "RANGE_ROWS", size)
    df = spark.range(500).select(
        F.when(F.col("id") % 10 < 7, "hot").when(F.col("id") % 10 < 9, F.col("id").cast("string"))
        .alias("g"),
        (F.col("id") * 37 % 500).alias("o"),
    ).withColumn("o", F.when(F.col("o") != 3, F.col("o")))
    out = ranges.number_within(df, ["g"], "o", "position").collect()
    for group in {r["g"] for r in out}:
        own = sorted((r for r in out if r["g"] == group), key=lambda r: -1 if r["o"] is None else r["o"])
        assert [r["position"] for r in own] == list(range(len(own)))


@pytest.mark.parametrize("size", [1_000_000, 40, 3])
def test_positions_of_equal_values(spark, size, monkeypatch):
    """One value fills most ranges; rows equal in the order come in one order at any cut."""
    monkeypatch.setattr(ranges, "RANGE_ROWS", size)
    df = spark.range(300).select("id", F.lit(None).cast("string").alias("g"), (F.col("id") % 10 == 9).cast("int").alias("o"))
    out = {r["id"]: r["position"] for r in ranges.number_within(df.repartition(3), ["g"], "o", "position").collect()}
    assert sorted(out.values()) == list(range(300))
    assert all(out[i] < 270 for i in range(300) if i % 10 < 9)
    assert out == {r["id"]: r["position"] for r in ranges.number_within(df.repartition(7), ["g"], "o", "position").collect()}


def test_dense_ids_do_not_depend_on_partitions(spark, monkeypatch):
    rows = [(i % 50, f"n{i % 50}", None if i % 3 else 0.5, [i % 2], {"k": i % 2}) for i in range(200)]
    df = spark.createDataFrame(rows, "a int, b string, c double, d array<int>, e map<string,int>")
    seen = []
    for parts, size in ((1, 1_000_000), (4, 13), (13, 90)):
        monkeypatch.setattr(ranges, "RANGE_ROWS", size)
        out = mapping.with_row_id(df.repartition(parts), "row").collect()
        assert sorted(int(r["row"]) for r in out) == list(range(200))
        seen.append(sorted((int(r["row"]), str(r.asDict() | {"row": 0})) for r in out))
    assert seen[0] == seen[1] == seen[2]
    assert mapping.with_row_id(df.limit(0)).count() == 0


def test_running_totals_read_the_source_twice(spark, tmp_path, plan_of):
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    plan = plan_of(ranges.number_within(spark.read.parquet(str(tmp_path / "t")), [], "id", "n"))
    assert str(tmp_path / "t") not in plan and "Window " in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("expand, years", [(None, (None, 2000, 2001, 2003)), (None, (2001, None)), (True, (2000, 2001)), (False, (2001,))])
def test_sums_per_year_stand_for_the_three_steps(spark, expand, years):
    rows = [(f"f{i}", None if y is None else day(y, 5), y, own) for i, y in enumerate(years) for own in (None, 10.0 + i, 20.0)]
    soils = spark.createDataFrame(rows, "field_id string, timestamp timestamp, year int, moisture double")
    for grid in ([(2001, 7.0), (2003, None), (1999, 3.0)], [(None, 4.0)]):
        annual = spark.createDataFrame(grid, "year int, moisture double")
        for one in (soils, soils.drop("moisture")):
            steps = enrich.fill_moisture(enrich.join_annual(enrich.expand_years(one, annual, expand), annual, True))
            found = enrich.fill_by_year(one, annual, expand)
            columns = ["field_id", "timestamp", "year", "moisture"]
            key = lambda r: str(tuple(r))
            assert sorted(found.select(columns).collect(), key=key) == sorted(steps.select(columns).collect(), key=key)


def test_distinct_elements_are_rows(spark):
    rows = [("a", ["y", "x", None]), ("a", ["x"]), ("b", []), (None, ["z"]), ("c", None)]
    lists = spark.createDataFrame(rows, "g string, e array<string>")
    overall = aggregates.distinct_elements(lists, F.col("e"), "word").collect()
    assert sorted((r.position, r.word) for r in overall) == [(0, "x"), (1, "y"), (2, "z")]
    grouped = aggregates.distinct_elements(lists, F.col("e"), "word", ["g"]).collect()
    assert {(r.g, r.position, r.word) for r in grouped} == {("a", 0, "x"), ("a", 1, "y"), (None, 0, "z")}
    assert aggregates.distinct_elements(lists.limit(0), F.col("e"), "word").count() == 0


def test_fan_out_joins_each_order_and_year_once(spark, tmp_path, monkeypatch, plan_of):
    lines = [(1, 1994), (1, 1994), (1, 1995), (2, 1994), (None, 1994), (None, 1994), (3, None), (4, 1999)]
    made = [(key, year and day(year, 5)) for key, year in lines]
    spark.createDataFrame(made, "l_orderkey long, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    dates = [(day(1994, 1, 3),), (day(1994, 1, 9),), (day(1994, 2),), (day(1995, 7),), (None,)]
    spark.createDataFrame(dates, "o_orderdate timestamp").write.parquet(f"{tmp_path}/orders.parquet")
    met, join = [], enrich.join_annual
    monkeypatch.setattr(enrich, "join_annual", lambda soils, annual: met.append(soils) or join(soils, annual))
    monkeypatch.setattr(enrichment, "ROWS_PER_TASK", 3, raising=False)
    found = enrichment.year_enrichment_fan_out(spark, str(tmp_path)).collect()
    assert {tuple(row) for row in found} == {
        (1994, 1.0, 5, 2), (1994, 2.0, 5, 2), (1995, 7.0, 1, 1), (None, None, 1, 1), (1999, None, 1, 1)
    }
    assert met[0].count() == 6  # orders of a year, not lines
    assert "REPARTITION_BY_NUM" in plan_of(met[0])  # three tasks for eight lines
