import math
import re
from collections import Counter

import pytest

from fieldlake.llm import lexical
from fieldlake.llm.lexical import op12_ranked_search, ranked_search
from fieldlake.llm.registry import ORACLES
from tests.oracle import connect, differences

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(rows, items, top):
    counted = [(doc, Counter(t), len(t)) for doc, text in rows if (t := terms(text))]
    number, total = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    for item, mine in wanted.items():
        scored = []
        for doc, c, n in counted:
            m = 100 - 50 + (50 * n * number) // total
            score = sum(
                math.floor(1000 * math.log((2 * number + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
                for t in mine
                if t in c
            )
            if score > 0:
                scored.append((-score, doc is None, doc))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, place + 1, s[2], -s[0]) for place, s in enumerate(scored[:top])]
    return sorted(out, key=str)


def rows_of(found):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in found.collect()), key=str)


@pytest.fixture
def table(prose):
    rows = list(enumerate(prose)) + [(70, None), (71, ""), (72, "..."), (73, prose[4]), (74, prose[4]), (74, prose[4])]
    rows += [(None, prose[7]), (75, "thth " * 30_000 + "12 THTH"), (76, "É é ß"), (77, "one")]
    items = [(n, text[:150]) for n, text in enumerate(prose[::5])] + [(90, "er on é"), (91, None), (92, "!!"), (0, prose[8])]
    return rows, items + [(None, "Thth. 12 an"), (93, "THTH thth"), (93, "THTH thth"), (94, "nowhere")]


@pytest.mark.parametrize("sizes", [{}, {"BLOCK_BYTES": 400}, {"ITEMS": 3, "DOCS": 7, "TERMS": 5, "SLICE_BYTES": 900}])
def test_same_as_brute_force(spark, docs, table, sizes, monkeypatch):
    for name, value in sizes.items():
        monkeypatch.setattr(lexical, name, value)
    rows, items = table
    benchmark = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, doc_id int")
    for top in (3, 50):
        assert rows_of(ranked_search(docs(rows).repartition(5), benchmark, top)) == brute(rows, items, top)


def test_wide_numbers():
    import numpy as np

    known = lexical.Statistics(10**12, 10**13, np.zeros(1, np.int64))
    got = lexical.impacts(np.array([3, 1]), np.array([10**9, 5]), known)
    m = [50 + 50 * n * 10**12 // 10**13 for n in (10**9, 5)]
    assert got.tolist() == [10**9 * t // (1000 * t + 20 * x) for t, x in zip((3, 1), m)]


def test_few_columns_when_weights_are_heavy(spark, docs, table, monkeypatch):
    rows, items = table
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(lexical, "EXACT", 20_000 * 10**6)
    assert rows_of(ranked_search(docs(rows), benchmark)) == brute(rows, items, 50)


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id string, text string")
    some = spark.createDataFrame([("a", "b c")], "item_id string, text string")
    assert ranked_search(docs([]), some).count() == 0
    found = ranked_search(docs([(1, "a b")]), none)
    assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0
    assert rows_of(ranked_search(docs([(1, "b a b")]), some)) == brute([(1, "b a b")], [("a", "b c")], 50)


def test_same_rows_as_sql(spark, sf_dir):
    found = op12_ranked_search(spark, sf_dir).toPandas()
    expected = connect(sf_dir).execute(ORACLES["op12_ranked_search"]).df()
    assert len(found) and differences(found, expected) == []
