import pytest
from pyspark.sql import functions as F

from fieldlake.operators import text_analysis as ta
from fieldlake.plans.documents import analyse_documents, analyse_files
from fieldlake.sources.catalogue import APPLICATIONS, applications

TEXTS = [
    "Quantum sensors detect entanglement; the quantum\nsensor market for navigation is a breakthrough.",
    "An optimization challenge: quantum computing, quantum algorithm and quantum supremacy.",
    "quantum quantum sensing and imaging Quantum",
    "Nothing to see here, move on.",
    "",
    "   ",
    "market commercial business industry application revenue profit investment funding startup "
    "enterprise customer product service solution",
]
LEXICON = ta.Lexicon()


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string")


@pytest.fixture(scope="module")
def found(corpus, spark):
    rows = ta.analyse(corpus, applications(spark)).collect()
    return {r["doc_id"]: r for r in rows}


def test_concepts(found):
    assert found[0]["concepts"] == [
        "Quantum sensors", "entanglement", "quantum", "quantum\nsensor", "sensor", "the quantum",
    ]
    assert found[2]["concepts"] == ["imaging Quantum", "quantum", "quantum quantum"]
    assert found[3]["concepts"] == [] == found[4]["concepts"]


def test_scores(found):
    assert found[0]["complexity_score"] == pytest.approx((3 + 1) / 21)
    assert found[1]["complexity_score"] == pytest.approx((3 + 2 * 3) / 21)
    assert found[0]["sentiment_score"] == pytest.approx(1 / len(TEXTS[0].split()))
    assert found[1]["sentiment_score"] == pytest.approx(-1 / len(TEXTS[1].split()))
    assert found[4]["sentiment_score"] == 0.0 == found[5]["sentiment_score"]
    assert found[6]["market_potential"] == "high" and found[3]["market_potential"] == "low"


def test_single_word_sentiment_is_bounded(spark):
    one = spark.createDataFrame([(1, "breakthroughinnovation")], "doc_id int, text string")
    assert ta.score_texts(one).first()["sentiment_score"] == 1.0


def brute_force(concepts):
    names = sorted(
        name
        for name, description, _, _ in APPLICATIONS
        if any(t in c.lower() for c in concepts for t in description.lower().split())
    )
    domains = {d for name, _, ds, _ in APPLICATIONS if name in names for d in ds}
    return names, sorted(domains)


def test_applications_like_brute_force(found):
    for row in found.values():
        assert (row["applications"], row["domains"]) == brute_force(row["concepts"])
    assert found[0]["applications"] and not found[3]["applications"]


def test_every_row_and_entry_matches_by_itself(spark):
    rows = [(1, ["Quantum sensor"]), (1, ["qubit"]), (None, ["qubit"]), (2, []), (3, None)]
    analysed = spark.createDataFrame(rows, "doc_id long, concepts array<string>")
    catalogue = spark.createDataFrame(
        [("A", "sensor", ["d1"]), ("A", "qubit", ["d2"]), ("B", "bit quantum", ["d3", "d1"]), ("C", None, ["d4"])],
        "name string, description string, domains array<string>",
    )
    found = ta.match_applications(analysed, catalogue).select(*analysed.columns, "applications", "domains")
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        [
            (1, ["Quantum sensor"], ["A", "B"], ["d1", "d3"]),
            (1, ["qubit"], ["A", "B"], ["d1", "d2", "d3"]),
            (None, ["qubit"], ["A", "B"], ["d1", "d2", "d3"]),
            (2, [], [], []),
            (3, None, [], []),
        ],
        key=str,
    )


def test_dataset_rows(corpus, spark):
    as_of = F.to_timestamp(F.lit("2024-01-31 00:00:00"))
    result = analyse_documents(corpus, as_of=as_of)
    rows = [r for r in result.concept_rows.collect() if r["doc_id"] == 1]
    analysis = result.analysis.filter("doc_id = 1").first()
    concepts = sorted((r for r in rows if r["type"] == "quantum_concept"), key=lambda r: int(r["id"][8:]))
    assert [r["text"] for r in concepts] == analysis["concepts"]
    assert [r["id"] for r in concepts] == [f"concept_{i}" for i in range(len(concepts))]
    apps = {r["id"]: r for r in rows if r["type"] == "quantum_application"}
    assert len(apps) == len(analysis["applications"]) == 5
    by_name = {name: (text, domains, potential) for name, text, domains, potential in APPLICATIONS}
    for i, name in enumerate(analysis["applications"]):
        row = apps[f"app_{i}"]
        assert (row["text"], row["business_domains"], row["market_potential"]) == by_name[name]
        assert row["timestamp"] == "2024-01-31T00:00:00Z"


def test_insights(corpus):
    rows = {r["doc_id"]: r for r in analyse_documents(corpus).insights.collect()}
    assert rows[3]["description"] == "Quantum sensor market analysis with 0 concepts identified"
    assert rows[1]["complexity_level"] == "medium" and rows[1]["confidence_score"] < 0
    flat = ta.with_json_lists(analyse_documents(corpus).insights.filter("doc_id = 3"), "business_domains")
    assert flat.first()["business_domains"] == "[]"


def test_files(spark, tmp_path):
    (tmp_path / "one.txt").write_text(TEXTS[0], encoding="utf-8")
    assert analyse_files(spark, str(tmp_path)).insights.count() == 1


def test_one_pass_over_the_text(spark, sf_dir, plan_of):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    result = analyse_documents(documents)
    plan = plan_of(result.concept_rows)
    assert plan.count("Scan parquet") == 6  # the stored rows thrice, each in the tree and the details
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "EvalPython" not in plan
