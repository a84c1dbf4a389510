import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fieldlake.operators import cells, embeddings, search
from fieldlake.operators.serialise import (
    JSON_FIELDS,
    row_json,
    with_generated_text,
    with_prompt,
    with_reading_json,
)
from fieldlake.plans.sensors import preview, run_sensor_pipeline
from fieldlake.sources.generator import generate_readings


@pytest.fixture(scope="module")
def vectors():
    made = np.random.default_rng(7).normal(size=(200, 8)).astype(np.float32)
    made /= np.linalg.norm(made, axis=1, keepdims=True)
    made[150:] = made[100]  # a quarter of the items are copies of one vector
    return made


@pytest.fixture(scope="module")
def items(spark, vectors):
    rows = [(i, v.tolist(), f"n{i}") for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "id int, embedding array<float>, name string").repartition(5)


def expected(vectors, query, k):
    scores = np.round(vectors.astype(np.float64) @ query.astype(np.float64), 12)
    order = sorted(range(len(scores)), key=lambda i: (-scores[i], i))[:k]
    return [(i, scores[i]) for i in order]


def test_exact_search(items, vectors, plan_of):
    query = items.filter("id = 100").select("embedding")
    found = search.similar(items, query, 7)
    rows = found.collect()
    assert [r["id"] for r in rows] == [i for i, _ in expected(vectors, vectors[100], 7)]
    assert rows[0]["name"] == "n100" and [r["id"] for r in rows[1:]] == [150, 151, 152, 153, 154, 155]
    plan = plan_of(found)
    assert "TakeOrderedAndProject" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("sizes", [{}, {"CELL_ROWS": 40, "LEAST_ROWS": 10}, {"SAMPLE": 30, "LEAST_ROWS": 10}])
def test_batch_search_by_cell(items, vectors, sizes, monkeypatch):
    for name, value in sizes.items():
        monkeypatch.setattr(cells, name, value)
    queries = items.filter("id % 20 = 0").select(F.col("id").alias("query_id"), "embedding")
    found = search.similar_batch(items, queries, 6).collect()
    assert len(found) == 60
    for query in range(0, 200, 20):
        rows = sorted((r for r in found if r["query_id"] == query), key=lambda r: r["rank"])
        want = expected(vectors, vectors[query], 6)
        assert [r["item_id"] for r in rows] == [i for i, _ in want]
        assert [r["score"] for r in rows] == pytest.approx([s for _, s in want])


def test_many_queries_few_items(spark, items, vectors, plan_of):
    """More queries than an array in the closure should hold; items are shuffled once."""
    copies = items.select("id", "embedding", F.explode(F.sequence(F.lit(0), F.lit(99))).alias("copy"))
    queries = copies.select((F.col("id") * 100 + F.col("copy")).alias("query_id"), "embedding")
    found = search.similar_batch(items, queries, 3)
    assert plan_of(found).count("REPARTITION_BY_NUM") == plan_of(queries).count("REPARTITION_BY_NUM") + 1
    assert found.count() == 60_000
    counts = found.filter("rank = 1").groupBy("item_id").count().collect()
    best = {i: expected(vectors, vectors[i], 1)[0][0] for i in range(200)}
    assert {r["item_id"]: r["count"] for r in counts} == {i: 100 * list(best.values()).count(i) for i in set(best.values())}


def clustered(spark, groups=30, each=40):
    """Tight clusters far from each other, one of them holding a third of the items."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(groups, 16)) * 10
    sizes = [each] * (groups - 1) + [groups * each // 2]
    made = np.concatenate([c + rng.normal(size=(n, 16)) * 0.05 for c, n in zip(centres, sizes)])
    rows = [(i, v.tolist()) for i, v in enumerate(made)]
    return made, spark.createDataFrame(rows, "id int, embedding array<double>")


def test_index_reads_the_cells_it_needs(spark, tmp_path, plan_of):
    made, items = clustered(spark)
    path = search.build_index(items, str(tmp_path / "index"))
    centres = spark.read.parquet(f"{path}/centres")
    assert centres.count() == 42 and centres.agg(F.sum("rows")).first()[0] == len(made) == 1760
    for item in (5, 700, 1500):
        query = items.filter(F.col("id") == item).select("embedding")
        needed = search.needed_cells(spark, path, query, 10, "id", "embedding")
        assert 1 <= len(needed) < 21
        found = search.search_index(spark, path, query, 10)
        assert "PartitionFilters: [cell" in plan_of(found)
        assert [r["id"] for r in found.collect()] == [i for i, _ in expected(made, made[item], 10)]
    queries = items.filter("id % 50 = 0").select(F.col("id").alias("query_id"), "embedding")
    found = search.search_index_batch(spark, path, queries, 10).collect()
    for query in range(0, 1760, 50):
        rows = sorted((r for r in found if r["query_id"] == query), key=lambda r: r["rank"])
        assert [r["item_id"] for r in rows] == [i for i, _ in expected(made, made[query], 10)]
    read = search.cells_needed(spark, path, queries, 10).first()
    assert read["cells"] == 36 * 42 and read["items"] == 36 * 1760
    assert read["needed"] < read["cells"] / 2 and read["items_needed"] < read["items"]
    recalls = {r["probes"]: r["recall"] for r in search.recall_by_probes(spark, path, queries, 10).collect()}
    assert max(recalls.values()) == 1.0 and list(recalls.values()) == sorted(recalls.values())
    enough = min(p for p, share in recalls.items() if share >= 0.9)
    some = search.search_index_batch(spark, path, queries, 10, probes=enough)
    hits = {(r["query_id"], r["item_id"]) for r in some.collect()} & {(r["query_id"], r["item_id"]) for r in found}
    assert len(hits) / len(found) == pytest.approx(recalls[enough])


def test_index_with_vectors_missing(spark, tmp_path):
    rows = [(1, [1.0, 0.0]), (2, None), (3, [0.5, None]), (4, [0.0, 1.0]), (5, [-1.0, 0.0]), (6, [float("nan"), 1.0]), (None, [0.9, 0.1])]
    items = spark.createDataFrame(rows, "id int, embedding array<double>")
    path = search.build_index(items, str(tmp_path / "index"), cells=2)
    query = spark.createDataFrame([([1.0, 0.0],)], "embedding array<double>")
    for k in (1, 2, 5, 9):
        exact = [r["id"] for r in search.similar(items, query, k).collect()]
        assert [r["id"] for r in search.search_index(spark, path, query, k).collect()] == exact
    none = spark.createDataFrame([(None,)], "embedding array<double>")
    assert search.search_index(spark, path, none, 3).count() == 3
    queries = spark.createDataFrame([(None, [1.0, 0.0]), (7, None)], "query_id int, embedding array<double>")
    found = search.search_index_batch(spark, path, queries, 9).orderBy("rank").collect()
    assert [(r["query_id"], r["item_id"]) for r in found] == [(None, 1), (None, None), (None, 4), (None, 5)]


def test_index_of_copies_and_of_nothing(spark, tmp_path):
    copies = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(30)], "id int, embedding array<double>")
    path = search.build_index(copies, str(tmp_path / "copies"))
    query = copies.filter("id = 3").select("embedding")
    assert [r["id"] for r in search.search_index(spark, path, query, 4).collect()] == [0, 1, 2, 3]
    path = search.build_index(copies.limit(0), str(tmp_path / "none"))
    assert search.search(copies.limit(0), query, 4, path).count() == 0
    path = search.build_index(copies.selectExpr("id", "cast(null AS array<double>) AS embedding"), str(tmp_path / "nulls"))
    assert search.search_index(spark, path, query, 4).count() == 4
    queries = query.withColumn("query_id", F.lit(1))
    assert search.search_index_batch(spark, path, queries, 4).count() == 0


def test_batch_with_text_ids_and_missing_vectors(spark):
    items = spark.createDataFrame(
        [("a", [1.0, 0.0]), ("b", [0.0, 1.0]), ("c", None)], "id string, embedding array<double>"
    )
    queries = spark.createDataFrame([("q", [2.0, 1.0])], "query_id string, embedding array<double>")
    found = search.similar_batch(items, queries, 5).orderBy("rank").collect()
    assert [(r["item_id"], r["score"]) for r in found] == [("a", 2.0), ("b", 1.0)]
    assert search.similar_batch(items, queries.limit(0), 5).count() == 0


def test_index(spark, items, vectors, tmp_path, plan_of):
    path = search.build_index(items, str(tmp_path / "index"), cells=6)
    assert spark.read.parquet(f"{path}/items").count() == 200
    query = items.filter("id = 3").select("embedding")
    exact = search.similar(items, query, 10)
    everything = search.search_index(spark, path, query, 10, probes=6)
    assert [r["id"] for r in everything.collect()] == [r["id"] for r in exact.collect()]
    some = search.search_index(spark, path, query, 10, probes=3)
    assert "PartitionFilters: [cell" in plan_of(some)
    assert 0.3 <= search.recall(some, exact).first()["recall"] <= 1.0
    assert search.search(items, query, 10, path, probes=6).count() == 10
    fallback = search.search(items, query, 10, str(tmp_path / "none"))
    assert [r["id"] for r in fallback.collect()] == [r["id"] for r in exact.collect()]


def test_embedding_is_a_unit_bag_of_words(spark):
    rows = [(1, "Alpha beta beta 2.5"), (2, "beta 2.5 ALPHA beta"), (3, ""), (4, None), (5, "gamma")]
    df = spark.createDataFrame(rows, "id int, text string")
    out = {r["id"]: np.array(r["embedding"]) for r in embeddings.embed_text(df, dimension=32).collect()}
    assert all(len(v) == 32 for v in out.values())
    assert np.allclose(out[1], out[2]) and np.linalg.norm(out[1]) == pytest.approx(1, abs=1e-6)
    assert not out[3].any() and not out[4].any()
    assert np.abs(out[5]).max() == 1.0


def test_text_search_finds_the_matching_text(spark):
    df = spark.createDataFrame(
        [(1, "drought stress in corn"), (2, "wet soil"), (3, "corn prices")], "id int, text string"
    )
    embedded = embeddings.embed_text(df, dimension=512)
    found = search.search_text(embedded, "Corn drought", 2, dimension=512).collect()
    assert [r["id"] for r in found] == [1, 3]
    tricky = search.search_text(embedded, "it's a 'quote'; drop", 1, dimension=512)
    assert tricky.count() == 1


def test_model_hooks(spark):
    df = spark.createDataFrame([("ab",), ("abc",)], "text string")
    out = embeddings.embed_with(df, lambda texts: np.array([[len(t), 1.0] for t in texts]))
    assert sorted(r["embedding"] for r in out.collect()) == [[2.0, 1.0], [3.0, 1.0]]
    readings = generate_readings(spark, samples=3)
    advice = with_generated_text(readings, lambda prompts, _: [p[:8] for p in prompts])
    assert {r["recommendation"] for r in advice.collect()} == {"Soil pH="}


def test_prompt_and_json(spark):
    df = spark.createDataFrame([(6.5, 10.0, 8.0, None)], "soil_ph double, nitrogen double, potassium double, moisture double")
    assert with_prompt(df).first()["prompt"] is None
    full = with_prompt(df.withColumn("moisture", F.lit(30.0)))
    assert full.first()["prompt"] == "Soil pH=6.5; N=10.0; K=8.0; moisture=30.0"
    assert df.select(row_json(df, ["soil_ph", "moisture"]).alias("j")).first()["j"] == '{"soil_ph":6.5,"moisture":null}'
    content = with_reading_json(generate_readings(spark, samples=1)).first()["content"]
    assert [part.split('"')[1] for part in content.strip("{}").split(',"') if part] [0] == "timestamp"
    assert all(f'"{name}":' in content for name in JSON_FIELDS)


def test_sensor_pipeline(spark, tmp_path):
    history = spark.range(20).select(
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).cast("timestamp").alias("timestamp"),
        F.lit("corn").alias("crop"),
        (F.col("id") * 2.0).alias("yield"),
    )
    run = run_sensor_pipeline(
        spark, str(tmp_path / "run"), samples=60, history=history, dimension=64, cells=4
    )
    assert spark.read.parquet(run.readings_path).count() == 60
    assert run.matches.count() == 3 and "score" in run.matches.columns
    values = [r["forecast_value"] for r in run.forecasts.orderBy("forecast_timestamp").collect()]
    assert values == pytest.approx([40.0 + 2 * i for i in range(14)])
    offline = run_sensor_pipeline(spark, str(tmp_path / "off"), samples=9, offline=True, coherent=False)
    stored = spark.read.option("header", True).csv(offline.readings_path)
    assert stored.count() == 9 and {r["q_value"] for r in stored.collect()} == {"0.5"}
    assert preview(stored, [F.asc("timestamp")], 2).count() == 2


def test_queries_sent_to_many_cells_leave_in_small_batches(monkeypatch):
    rng = np.random.default_rng(3)
    some = cells.Cells(rng.normal(size=(40, 4)), np.full(40, 9.0), np.full(40, 5))
    vectors = rng.normal(size=(100, 4))
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(100)), pa.array(vectors.tolist())], ["query_id", "vector"])
    kernel = cells.query_kernel(some, rng.normal(size=(50, 4)), 3, None)
    monkeypatch.setattr(cells, "SENT_BYTES", 8 * 4 * 64, raising=False)
    sent = list(kernel(iter([batch])))
    assert max(part.num_rows for part in sent) <= 64
    pairs = {pair for part in sent for pair in zip(part.column("query_id").to_pylist(), part.column("cell").to_pylist())}
    assert len(pairs) == sum(part.num_rows for part in sent) == 100 * 40  # every cell may hold a best one
    assert all(part.column("vector").to_pylist() == vectors[part.column("query_id").to_numpy()].tolist() for part in sent)


def test_items_meet_a_bounded_number_of_queries_at_once(monkeypatch):
    rng, met = np.random.default_rng(4), []
    vectors = rng.normal(size=(30, 4))
    rows = [(0, 0, 0, 0, None, f"v{n}", v, None) for n, v in enumerate(vectors.tolist())]
    rows += [(0, 0, 0, 1, n, None, v, -9.0) for n, v in enumerate(vectors.tolist())]
    names = ["cell", "salt", "part", "asks", "query_id", "item_id", "vector", "floor"]
    batch = pa.RecordBatch.from_arrays([pa.array(list(column)) for column in zip(*rows)], names)
    rank = cells.rank_block
    monkeypatch.setattr(cells, "rank_block", lambda queries, *rest: met.append(len(queries)) or rank(queries, *rest))
    monkeypatch.setattr(cells, "QUERIES_AT_ONCE", 7, raising=False)
    found = pa.Table.from_batches(cells._match_kernel(2)(iter([batch]))).to_pylist()
    assert max(met) == 7 and sum(met) == 30
    for n, scores in enumerate(vectors @ vectors.T):
        best = sorted(range(30), key=lambda i: (-round(scores[i], 12), f"v{i}"))[:2]
        assert [row["item_id"] for row in found if row["query_id"] == n] == [f"v{i}" for i in best]
