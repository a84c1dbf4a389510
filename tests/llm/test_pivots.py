import math

import numpy as np

from fieldlake.llm import pivots
from fieldlake.llm.pivots import near_vectors, recall


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, node int, pivots int")


def brute(rows, threshold):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if v is not None and None not in v and all(map(math.isfinite, v)) and any(v)]
    links, group = {i: 0 for i, _ in rows}, {i: i for i, _ in rows}
    pairs = []
    for a, (i, u) in enumerate(good):
        for j, v in good[a + 1 :]:
            if len(u) == len(v) and u @ v / np.linalg.norm(u) / np.linalg.norm(v) >= threshold:
                links[i] += 1
                links[j] += 1
                pairs.append((i, j))
    for _ in rows:
        for i, j in pairs:
            group[i] = group[j] = min(group[i], group[j])
    return {i: (links[i], group[i], group[i] == i) for i in links}


def crowd(seed, n, dims=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    return [(int(k), (centres[k % 12] + 0.25 * rng.normal(size=dims)).tolist()) for k in range(n)]


def test_same_as_brute_force(spark, monkeypatch):
    monkeypatch.setattr(pivots, "CHUNK", 16)
    rows = crowd(1, 200) + [(300 + k, crowd(1, 1)[0][1]) for k in range(30)]
    rows += [(400, None), (401, [0.0] * 8), (402, [1.0, None] + [0.0] * 6), (403, [math.nan] * 8), (404, [math.inf] + [1.0] * 7)]
    rows += [(405, [1.0, 2.0]), (406, [1.0, 2.1]), (407, []), (408, [1e30] * 8), (409, [1e-30] * 8)]
    found = near_vectors(table(spark, rows), 0.9)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found.collect()}
    want = brute(rows, 0.9)
    hit = sum(got[i] == want[i] for i in want) / len(want)
    assert got.keys() == want.keys() and hit >= 0.95
    assert all(got[i][0] <= want[i][0] for i in want)
    assert {i: (got[i], want[i]) for i in want if i >= 400 and got[i] != want[i]} == {}
    assert recall(table(spark, rows), found, 0.9, 5) >= 0.95


def test_empty_table(spark):
    assert near_vectors(table(spark, []), 0.9).count() == 0


def test_rows_without_an_id_count_and_connect(spark):
    rows = [(1, [1.0, 0.0, 0.0]), (None, [1.0, 0.01, 0.0]), (None, [1.0, 0.3, 0.0]), (None, [1.0, 0.3, 0.0])]
    rows += [(5, [1.0, 0.7, 0.0]), (None, [0.0, 0.0, 1.0]), (None, [0.0, 0.01, 1.0]), (2**63 - 1, [0.0, -1.0, 0.0])]
    found = near_vectors(table(spark, rows), 0.9)
    got = sorted([(r.vec_id, r.n_links, r.component_id, r.kept) for r in found.collect()], key=str)
    middle = [(None, 4, 1, False)] * 2
    want = [(1, 3, 1, True), (None, 3, 1, False), *middle, (5, 2, 1, False)]
    want += [(None, 1, None, True)] * 2 + [(2**63 - 1, 0, 2**63 - 1, True)]
    assert got == sorted(want, key=str)
