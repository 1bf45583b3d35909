import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lectern.llm import backoff as op
from tests.llm import samples


def brute(rows, order, alpha=op.ALPHA):
    split = [samples.lower(t).split() for _, t in rows]
    grams = lambda s: Counter(tuple(s[i : i + n]) for n in range(1, order + 1) for i in range(len(s) - n + 1))
    own = [grams(s) for s in split]
    total = sum(own, Counter())
    words = sum(map(len, split))
    out = []
    for (doc_id, _), s, mine in zip(rows, split, own, strict=True):
        rest = lambda g, mine=mine: total[g] - mine[g]
        score = 0.0
        for i in range(len(s)):
            for n in range(min(order, i + 1), 0, -1):
                g, back = tuple(s[i - n + 1 : i + 1]), alpha ** (min(order, i + 1) - n)
                if n == 1:
                    score += math.log10(back * (rest(g) or 0.5) / max(1, words - len(s)))
                elif rest(g):
                    score += math.log10(back * rest(g) / rest(g[:-1]))
                    break
        out.append((doc_id or -1, len(s), round(score, 6), round(score / len(s), 6) if s else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("order", [1, 2, 3])
@pytest.mark.parametrize("parts,chunk_bits", [(None, 11), (1, 1), (7, 2)])
def test_against_brute_force(spark, order, parts, chunk_bits):
    rows = [(i, samples.words(i, i % 40, 30)) for i in range(60)] + [(i, t) for i, t, *_ in samples.rows()]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, n_words int, part int")
    scored = op.backoff_scores(docs, order=order, parts=parts, chunk_bits=chunk_bits).collect()
    got = [
        (r.doc_id or -1, r.n_words, round(r.log_score, 6), None if r.mean_log_score is None else round(r.mean_log_score, 6))
        for r in scored
    ]
    for a, b in zip(sorted(got, key=str), brute(rows, order), strict=True):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], abs=1e-5) and (a[3] is None) == (b[3] is None)


def test_odd_rows(spark):
    assert op.backoff_scores(samples.empty(spark)).count() == 0
    alone = op.backoff_scores(samples.simple(spark, [(1, "a b a")])).collect()
    assert len(alone) == 1 and math.isfinite(alone[0].log_score)
    nothing = op.backoff_scores(samples.simple(spark, [(1, None), (2, " ")])).collect()
    assert {(r.n_words, r.log_score, r.mean_log_score) for r in nothing} == {(0, 0.0, None)}


def test_keys_and_texts_travel_small():
    """At 64 bits, 10,000 sorted keys of a partition in 140 have gaps of about 44 bits."""
    random = np.random.default_rng(3)
    keys = np.unique(random.integers(0, (1 << 64) // 140, 10_000, np.uint64))
    packed = op._packed_sorted(keys)
    assert (op._unpacked_sorted(packed) == keys).all() and len(packed) < 5.9 * len(keys)
    counts = np.where(random.random(10_000) < 0.1, 300, 1)
    assert (op._unpacked(op._packed(counts)) == counts).all() and len(op._packed(counts)) < 0.3 * len(counts)
    assert len(op._unpacked(op._packed(keys[:0]))) == 0
    rows = pa.table({"chunk": [1, 1], "doc_id": [1, None], "text": ["many words " * 500, None]})
    assert pa.ipc.open_stream(op._block(rows)).read_all() == rows and len(op._block(rows)) < 2_000
