import math
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from lectern.llm import topk as op

SCHEMA = "vec_id long, embedding array<float>, rank int, score double"


def brute(rows, queries, k):
    """Best score per (query id, vector id), as the docstring defines it."""
    def whole(v):
        if not v or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(256 * float(np.float32(x))) for x in v]

    pool = [(i, whole(v)) for i, v in rows if i is not None and whole(v) is not None]
    out = set()
    for query in {i for i, _ in queries}:
        best = {}
        for q, v in queries:
            if q != query or q is None or whole(v) is None:
                continue
            for i, c in pool:
                if i != q and len(c) == len(whole(v)):
                    score = sum(a * b for a, b in zip(whole(v), c, strict=True))
                    best[i] = max(score, best.get(i, score))
        ranked = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
        out |= {(query, r + 1, i, s) for r, (i, s) in enumerate(ranked)}
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, v, 9, 0.5) for i, v in rows], SCHEMA).repartition(4)


@pytest.mark.parametrize("k,block_rows,query_values", [(5, 8192, 1 << 18), (3, 7, 40), (200, 16, 1 << 18)])
def test_against_brute_force(spark, k, block_rows, query_values):
    rnd = random.Random(k)
    rows = [(i, [rnd.gauss(0, 0.3) for _ in range(8)]) for i in range(120)]
    rows += [(200 + i, rows[i % 3][1]) for i in range(10)]  # ties
    rows += [(300, [1.0, 2.0]), (301, [0.5, -1.0]), (302, [0.0] * 8), (303, None), (304, []), (305, [None] * 8)]
    rows += [(306, [float("nan")] * 8), (307, [float("inf")] * 8), (None, [1.0] * 8), (5, rows[5][1]), (6, rows[9][1])]
    queries = [r for r in rows if r[0] is None or r[0] % 10 in (0, 5, 6)]
    found = op.top_k_search(table(spark, queries), table(spark, rows), k=k, block_rows=block_rows, query_values=query_values)
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows, queries, k)


def test_empty_tables(spark):
    some, none = table(spark, [(1, [1.0])]), spark.createDataFrame([], SCHEMA)
    assert op.top_k_search(none, some).count() == 0
    assert op.top_k_search(some, none).count() == 0
    assert op.top_k_search(some, some).count() == 0  # only the query itself


def test_stops_early():
    rnd = np.random.default_rng(1)
    vectors = np.floor(256 * rnd.standard_normal((4000, 4)) ** 3).astype(np.int64)
    block, query = op.Block(np.arange(4000), vectors), np.array([300, -2, 1, 0])
    best = op.Best(5)
    scored = block.search(-1, query, best)
    order = np.lexsort((np.arange(4000), -(vectors @ query)))[:5]
    assert best.ids.tolist() == order.tolist()
    assert scored < 1000


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 4), st.integers(1, 40), st.integers(1, 6), st.integers(0, 10**6), st.sampled_from([3, 50, 1 << 40]))
def test_blocks_against_sorting(dimension, rows, k, seed, size):
    rnd = np.random.default_rng(seed)
    vectors = rnd.integers(-size, size + 1, (rows, dimension))
    query = rnd.integers(-3, 4, dimension)
    best = op.Best(k)
    op.Block(rnd.permutation(rows), vectors).search(0, query, best, steps=1)
    ids = np.random.default_rng(seed)
    ids.integers(-size, size + 1, (rows, dimension)), ids.integers(-3, 4, dimension)
    ids = ids.permutation(rows)
    pairs = sorted((-int(s), int(i)) for s, i in zip(vectors @ query, ids, strict=True) if i != 0)[:k]
    assert list(zip((-best.scores).tolist(), best.ids.tolist(), strict=True)) == pairs


@pytest.mark.parametrize("size", [100, 32_767, 32_768, 1 << 40])
def test_stored_blocks_come_back(size):
    rnd = np.random.default_rng(size)
    block = op.Block(rnd.permutation(30), np.r_[rnd.integers(-size, size + 1, (29, 3)), [[size, -size, 0]]])
    again = op.Block.from_row(*block.to_row())
    for name in ("ids", "vectors", "lists", "sorted"):
        assert np.array_equal(getattr(block, name), getattr(again, name))


def test_blocks_hold_one_dimension_and_few_values(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(op, "BLOCK_VALUES", 12)
    vectors = [[i] * (2 + i % 3) for i in range(40)]
    batches = [
        pa.RecordBatch.from_arrays([pa.array(range(a, a + 10), pa.int64()), pa.array(vectors[a : a + 10], pa.list_(pa.int64()))], names=["vec_id", "v"])
        for a in range(0, 40, 10)
    ]
    blocks = list(op._blocks(iter(batches), 5))
    assert sorted(i for b in blocks for i in b.ids.tolist()) == list(range(40))
    assert all(len(b.ids) <= min(5, 12 // b.vectors.shape[1]) for b in blocks)
    assert all((b.vectors == b.ids[:, None]).all() for b in blocks)
