import re

import numpy as np
import pytest

from fieldlake.llm import decontaminate
from fieldlake.llm.decontaminate import FMIndex, contamination, find_windows, windows_of, without_spans

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(rows, items, size):
    windows = {}
    for item, text in items:
        w = words(text)
        for at in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[at : at + size]), set()).add(item)
    found = []
    for doc, text in rows:
        w = words(text)
        hit, hits = [0] * len(w), set()
        for window, owners in windows.items():
            for at in range(len(w) - len(window) + 1):
                if tuple(w[at : at + len(window)]) == window:
                    hits |= owners
                    hit[at : at + len(window)] = [1] * len(window)
        found.append((doc, len(w), sum(hit), sorted(str(i) for i in hits if i is not None)))
    return sorted(found, key=str)


@pytest.mark.parametrize("block", [8 << 20, 200])
def test_same_as_brute_force(spark, docs, prose, block, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    items = [(n, text[:150]) for n, text in enumerate(prose[::3])] + [(90, "er on"), (91, None), (92, "!!"), (0, prose[0][:150])]
    items += [(None, "Thth. 12 an"), (93, "ONE two THREE four five six seven eight nine ten eleven")]
    rows = list(enumerate(prose)) + [(70, None), (71, ""), (72, "..."), (72, "..."), (None, prose[3])]
    rows += [(73, "x one-two/three FOUR five six seven eight nine ten, eleven"), (74, "thth 12 an " * 3000)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = [(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in contamination(docs(rows), benchmark, 10).collect()]
    assert sorted(got, key=str) == brute(rows, items, 10)


def test_spans_are_cut(spark, docs):
    benchmark = spark.createDataFrame([(1, "b c d")], "item_id long, text string")
    found = contamination(docs([(1, "a, B c. D! é b c d"), (2, None)]), benchmark, 10, ("block",))
    assert {r.doc_id: (r.text, r.block) for r in without_spans(found).collect()} == {1: ("a, ! é ", 2), 2: (None, 2)}


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination(docs([]), none).count() == 0
    row = contamination(docs([(1, "a b")]), none).first()
    assert (row.n_words, row.n_hit, row["items"], row.spans) == (2, 0, [], [])


def test_index_finds_every_place():
    rng = np.random.default_rng(3)
    symbols = rng.integers(0, 5, 2000)
    symbols[0] = symbols[-1] = 0
    index = FMIndex(symbols)
    patterns = rng.integers(1, 5, (50, 4))
    low, high = index.search(patterns, np.full(50, 4))
    for pattern, a, b in zip(patterns, low, high):
        places = [k for k in range(1997) if (symbols[k : k + 4] == pattern).all()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == places


def test_index_lacks_larger_symbols():
    symbols = np.array([0, 1, 3, 2, 0, 3, 1, 0])
    patterns = np.array([[1, 3], [4, 0], [5, 0], [3, 9], [9, 3], [3, 1]])
    low, high = FMIndex(symbols).search(patterns, np.array([2, 1, 1, 2, 2, 2]))
    assert (high - low).tolist() == [1, 0, 0, 0, 0, 1]


def test_slices_with_few_words_of_the_benchmark():
    vocabulary = [f"word{n}" for n in range(40)]
    known = windows_of([*((n, word) for n, word in enumerate(vocabulary)), (50, " ".join(vocabulary))], 10)
    for number, word in enumerate(vocabulary):
        data = np.frombuffer(f"{word} x {word}".encode(), np.uint8)
        *_, begin, window = find_windows(data, np.array([0, len(data)]), known)
        assert sorted(begin.tolist()) == [0, 2]
        assert [known.items[hit].tolist() for hit in window] == [[number]] * 2
