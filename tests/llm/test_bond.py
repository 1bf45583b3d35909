import math
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lectern.llm import bond as op

SCHEMA = "vec_id long, embedding array<float>, label int, rank int, score double, window string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, c, 9, 0.5, "w") for i, v, c in rows], SCHEMA).repartition(3)


def brute(rows, is_anchor, positives, negatives, low, high):
    def whole(v):
        if not v or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(256 * float(np.float32(x))) for x in v]

    pool = [(i, whole(v), c) for i, v, c in rows if i is not None and c is not None and whole(v) is not None]
    out = []
    for anchor in sorted({i for i, _, _ in pool if is_anchor(i)}):
        label, vector = min((c, v) for i, v, c in pool if i == anchor)

        def best(others, k):
            scores = {}
            for i, v, _ in others:
                if i != anchor and len(v) == len(vector):
                    s = sum(a * b for a, b in zip(v, vector, strict=True))
                    scores.setdefault(i, []).append(s)
            return scores

        own = {i: max(s) for i, s in best([r for r in pool if r[2] == label], 0).items()}
        for positive, score in sorted(own.items(), key=lambda x: (-x[1], x[0]))[:positives]:
            other = {
                i: max(t for t in s if low * score <= 100 * t <= high * score)
                for i, s in best([r for r in pool if r[2] != label], 0).items()
                if any(low * score <= 100 * t <= high * score for t in s)
            }
            ranked = sorted(other.items(), key=lambda x: (-x[1], x[0]))[:negatives]
            out += [(anchor, positive, r + 1, i, score, s) for r, (i, s) in enumerate(ranked)]
    return sorted(out)


def rows_of(seed, n, dim, labels=3, positive=True):
    rnd = random.Random(seed)
    draw = (lambda: abs(rnd.gauss(0.3, 0.2))) if positive else (lambda: rnd.gauss(0, 0.4))
    return [(i, [draw() for _ in range(dim)], rnd.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize(
    "positives,negatives,window,block_values,anchor_values",
    [(5, 3, (50, 95), 1 << 19, 1 << 18), (2, 4, (30, 80), 40, 24), (40, 70, (0, 100), 64, 1 << 18)],
)
def test_against_brute_force(spark, positives, negatives, window, block_values, anchor_values):
    rows = rows_of(positives, 130, 8, positive=positives != 2)
    rows += [(200 + i, rows[i % 4][1], i % 3) for i in range(12)]  # ties
    rows += [(300, [1.0, 2.0], 0), (301, [0.5, 0.5], 0), (302, [0.4, 0.7], 1), (305, [0.0] * 8, 1)]
    rows += [(310, None, 0), (311, [], 1), (312, [None] * 8, 0), (313, [float("nan")] * 8, 0), (314, [float("inf")] * 8, 2)]
    rows += [(315, [0.2] * 8, None), (None, [0.3] * 8, 1)]
    rows += [(5, rows[5][1], rows[5][2]), (6, rows[9][1], rows[6][2]), (10, rows[3][1], (rows[10][2] + 1) % 3)]  # repeated ids
    found = op.hard_negatives(
        table(spark, rows), F.col("vec_id") % 5 == 0, positives=positives, negatives=negatives, window=window,
        block_values=block_values, anchor_values=anchor_values,
    )
    got = sorted(map(tuple, found.collect()))
    assert got == brute(rows, lambda i: i % 5 == 0, positives, negatives, *window) and got


def test_label_expression(spark):
    rows = rows_of(1, 60, 6)
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 3).otherwise(F.col("label"))
    got = sorted(map(tuple, op.hard_negatives(table(spark, rows), F.col("vec_id") % 10 == 0, label=moved).collect()))
    changed = [(i, v, (c + 1) % 3 if i % 7 == 0 else c) for i, v, c in rows]
    assert got == brute(changed, lambda i: i % 10 == 0, 5, 3, 50, 95) and got


def test_no_partners(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert op.hard_negatives(none).count() == 0
    assert op.hard_negatives(table(spark, [(1, [1.0], 0)])).count() == 0
    assert op.hard_negatives(table(spark, [(1, [1.0], 0), (2, [1.0], 1)])).count() == 0  # no positive
    assert op.hard_negatives(table(spark, [(1, [1.0], 0), (2, [-1.0], 0), (3, [-0.7], 1)])).count() == 0  # below zero


def test_reads_a_part_of_the_values():
    rnd = np.random.default_rng(5)
    values = np.floor(256 * rnd.standard_normal((32, 4000)) * np.r_[np.full(4, 8.0), np.full(28, 0.1)][:, None]).astype(np.int64)
    block = op.Block(np.arange(4000), np.zeros(4000, np.int64), values)
    anchor = values[:, 7]
    wanted = op.Wanted([(None, None)], 5)
    read = block.scan(anchor, block.ids != 7, wanted)
    scores = anchor @ values
    order = [i for i in np.lexsort((np.arange(4000), -scores)).tolist() if i != 7][:5]
    assert wanted.ids[0].tolist() == order and wanted.scores[0].tolist() == scores[order].tolist()
    assert read < 0.4 * values.size


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 20), st.integers(1, 60), st.integers(1, 4), st.integers(0, 10**6), st.sampled_from([2, 60, 1 << 40]))
def test_blocks_against_sorting(dimension, rows, k, seed, size):
    rnd = np.random.default_rng(seed)
    values = rnd.integers(-size, size + 1, (dimension, rows))
    block = op.Block(rnd.permutation(rows), rnd.integers(0, 2, rows), values)
    stored = op.Block.from_row(*block.to_row())
    assert (stored.columns == values).all() and (stored.ids == block.ids).all()
    anchor = rnd.integers(-3, 4, dimension)
    windows = [(None, None), (0, 5 * size), (-size, 2)]
    wanted = op.Wanted(windows, k)
    alive = rnd.integers(0, 3, rows) > 0
    stored.scan(anchor, alive, wanted)
    scores = anchor @ values
    for (first, last), ids, found in zip(windows, wanted.ids, wanted.scores, strict=True):
        fit = [
            (-int(s), int(i))
            for s, i, a in zip(scores, block.ids, alive, strict=True)
            if a and (first is None or s >= first) and (last is None or s <= last)
        ]
        assert list(zip((-found).tolist(), ids.tolist(), strict=True)) == sorted(fit)[:k]
