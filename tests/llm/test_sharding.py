import zlib

import numpy as np
import pytest

from fieldlake.llm.sharding import assign_shards, cut, plan_shards, smallest_capacity


def placed(df, shards):
    return [(r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in assign_shards(df, shards).collect()]


def test_every_row_once_with_gapless_slots_and_whole_groups(docs, prose):
    rows = list(enumerate(prose)) + [(n + 100, prose[0]) for n in range(40)] + [(None, "x"), (7, None), (8, ""), (9, "y" * 20_000), (9, "y" * 20_000)]
    got = placed(docs(rows), 7)
    want = sorted((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows if i is not None)
    assert sorted(r[:3] for r in got if r[0] is not None) == want and len(got) == len(rows)
    shard_of = {}
    for _, _, crc, shard, _ in got:
        assert shard_of.setdefault(crc, shard) == shard
    for shard in range(7):
        slots = sorted(r[4] for r in got if r[3] == shard)
        assert slots == list(range(len(slots)))


def test_near_equal_beside_a_large_group(docs):
    rows = [(n, f"text {n} " + "z" * 80) for n in range(2000)] + [(5000 + n, "hot" * 30) for n in range(1000)]
    sizes = np.zeros(10)
    for _, size, _, shard, _ in placed(docs(rows), 10):
        sizes[shard] += size
    others = np.sort(sizes)[:-1]
    assert others.max() < 1.05 * others.mean()


def test_empty_table(docs):
    assert placed(docs([]), 4) == []


@pytest.mark.parametrize("seed", range(5))
def test_smallest_capacity(seed):
    rng = np.random.default_rng(seed)
    sizes, shards = rng.integers(1, 50, 12), 4
    prefix = np.concatenate([[0], np.cumsum(sizes)])

    def best(start, left):
        if left == 1:
            return prefix[-1] - prefix[start]
        return min(max(prefix[k] - prefix[start], best(k, left - 1)) for k in range(start, len(sizes) + 1))

    capacity = smallest_capacity(prefix, shards)
    assert capacity == best(0, shards)
    starts = [*cut(sizes, shards), len(sizes)]
    assert max(sizes[a:b].sum() for a, b in zip(starts, starts[1:])) <= capacity and len(starts) == shards + 1


def test_atoms_above_the_share_stand_alone():
    assert plan_shards({3: 100, 1: 5, 2: 5}, 3) == ({3: 0}, [1, 2])
