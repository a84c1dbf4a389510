import pytest

DOCS = "doc_id long, text string, spans string, ids long, component_id string, block int"


@pytest.fixture
def docs(spark):
    """Builds documents with extra columns whose names the operators use themselves."""

    def build(rows):
        return spark.createDataFrame([(*row, "x", 1, "y", 2) for row in rows], DOCS)

    return build


@pytest.fixture(scope="session")
def prose():
    """Reproducible texts: sentences of made-up words, some shared between texts."""
    import random

    random.seed(5)
    words = ["".join(random.choice(["th", "er", "on", "an", "re", "é", "ß"]) for _ in range(n % 4 + 1)) for n in range(400)]
    sentence = lambda n: " ".join(random.choice(words) for _ in range(n))
    shared = [sentence(30) for _ in range(5)]
    texts = []
    for n in range(60):
        parts = [sentence(random.randint(1, 60)) for _ in range(random.randint(1, 4))]
        if n % 3 == 0:
            parts.insert(random.randint(0, len(parts)), shared[n % 5])
        texts.append("\n".join(parts))
    return texts
