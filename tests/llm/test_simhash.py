import itertools

import numpy as np
import xxhash
from pyspark.sql import functions as F

from fieldlake.llm import simhash
from fieldlake.llm.simhash import covering_masks, fingerprint, near_duplicates, near_links


def brute_print(text, size=3):
    words = (text or "").encode().lower().split() if (text or "").isascii() else (text or "").translate({i: i + 32 for i in range(65, 91)}).encode().split()
    grams = [b" ".join(words[k : k + size]) for k in range(len(words) - size + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_groups(prints, radius):
    ids = list(prints)
    group = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in itertools.combinations(ids, 2):
            if bin(prints[a] ^ prints[b]).count("1") <= radius and group[a] != group[b]:
                group[a] = group[b] = min(group[a], group[b])
                changed = True
    return group


def test_same_as_brute_force(docs, prose):
    rows = list(enumerate(prose)) + [(100 + n, t) for n, t in enumerate(prose[:4])]
    rows += [(200, None), (201, ""), (202, " \t"), (203, "one two"), (204, "ONE  two"), (205, "word " * 5000), (None, prose[0])]
    rows += [(300 + n, " ".join(prose[:20]) + " end" * n) for n in range(12)]
    got = {r.doc_id: r for r in near_duplicates(docs(rows)).collect()}
    prints = {i: brute_print(t) for i, t in rows if i is not None}
    groups = brute_groups(prints, 2)
    assert {i: (r.fingerprint, r.component_id) for i, r in got.items() if i is not None} == {
        i: (f"{p:016x}", groups[i]) for i, p in prints.items()
    }
    assert got[None].component_id == 0


def test_masks_cover_every_pair_of_bits():
    masks = [mask & (1 << 64) - 1 for mask in covering_masks(2)]
    for a, b in itertools.combinations(range(64), 2):
        assert any(not mask >> a & 1 and not mask >> b & 1 for mask in masks)


def test_large_buckets_lose_no_link(spark, monkeypatch):
    rng = np.random.default_rng(1)
    base = int(rng.integers(1 << 62))
    prints = {n: base ^ (1 << int(a)) ^ (1 << int(b)) ^ (1 << int(c)) for n, (a, b, c) in enumerate(rng.integers(0, 64, (80, 3)))}
    prints = {n: p for p, n in {p: n for n, p in prints.items()}.items()}
    signed = [(n, p - (1 << 64) if p >> 63 else p) for n, p in prints.items()]
    table = spark.createDataFrame(signed, "node long, fingerprint long")
    want = brute_groups(prints, 2)
    for limit in (1024, 3):
        monkeypatch.setattr(simhash, "BUCKET", limit)
        group = dict.fromkeys(prints)
        group = {n: n for n in prints}
        links = [(r.u, r.v) for r in near_links(table, 2).collect()]
        for _ in prints:
            for u, v in links:
                group[u] = group[v] = min(group[u], group[v])
        assert group == want


def test_empty_table_and_chunks(docs):
    assert near_duplicates(docs([])).count() == 0
    assert fingerprint(b"", 3) == 0


def test_rows_without_an_id_connect_others(spark):
    middle = " ".join(f"w{n}" for n in range(400))
    apart = lambda a, b: bin(brute_print(a) ^ brute_print(b)).count("1")
    ends = [t for t in (middle.replace(f"w{n} ", f"v{n} ") for n in range(100, 400)) if 0 < apart(t, middle) <= 2]
    left, right = next((a, b) for a in ends for b in ends if apart(a, b) > 2)
    rows = [(7, left), (None, middle), (3, right), (None, "alone in this"), (None, "Alone in THIS")]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("component", F.lit("x"))
    found = {r.text: r for r in near_duplicates(table, 3, 2, ("text",)).collect()}
    assert [found[t].component_id for t in (left, middle, right)] == [3, 3, 3]
    assert len({found[t].component for t in (left, middle, right)}) == 1
    assert found["alone in this"].component_id is None
    assert found["alone in this"].component == found["Alone in THIS"].component != found[left].component
