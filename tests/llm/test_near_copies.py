import random

import numpy as np
import pytest

import corpus_pipeline
from lectern.llm import near_copies as op
from tests.llm import samples


def jaccard(a, b):
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a.split(), b.split())]
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def edited(seed, low, high, n=400):
    """A text and a copy of it with edited words, of a similarity within the bounds."""
    rnd = random.Random(seed)
    base = samples.words(seed, n, 100_000)
    words = base.split()
    while True:
        words[rnd.randrange(n)] = f"x{rnd.random()}"
        copy = " ".join(words)
        if low <= jaccard(base, copy) < high:
            return base, copy


@pytest.mark.parametrize("low,high", [(0.8, 0.85), (0.85, 0.9)])
def test_lone_near_copies_are_dropped(spark, low, high):
    pairs = [t for seed in range(150) for t in edited(seed, low, high)]
    docs = samples.simple(spark, list(enumerate(pairs)))
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()}
    assert set(range(0, 300, 2)) <= kept
    assert sum(i in kept for i in range(1, 300, 2)) <= 1


SMALL = {"part_rows": 8, "cell_rows": 16, "cell_bytes": 20_000}


@pytest.mark.parametrize("options", [{}, SMALL])
def test_documents_that_share_a_long_passage_stay(spark, options):
    passage = samples.words(1, 400, 100_000)
    texts = [f"{passage} {samples.words(s, 85, 100_000)}" for s in range(10, 130)]
    assert 0.6 < jaccard(texts[0], texts[1]) < 0.75
    copies = [t.rsplit(" ", 3)[0] for t in texts[:20]]
    docs = samples.simple(spark, list(enumerate(texts + copies)))
    kept = {r.doc_id for r in op.one_per_group(docs, **options).collect()}
    assert kept == set(range(120))


def test_a_large_group_of_near_copies(spark):
    base = samples.words(3, 300, 100_000)
    docs = samples.simple(spark, [(i, f"{base} t{i}") for i in range(200)])
    assert [r.doc_id for r in op.one_per_group(docs).collect()] == [0]


@pytest.mark.parametrize("options", [{}, SMALL])
def test_a_whole_table_against_brute_force(spark, options):
    """Families of edited texts, one of them large, whose members are near to some of the others only."""
    rnd = random.Random(9)
    texts = []
    for family in range(30):
        words = samples.words(family, 60, 100_000).split()
        for _ in range(60 if family == 0 else 4):
            copy = list(words)
            for _ in range(rnd.randrange(4)):
                copy[rnd.randrange(60)] = f"x{rnd.randrange(10**6)}"
            texts.append(" ".join(copy))
            if rnd.random() < 0.3:
                words = copy  # the next ones are edits of an edit
    rnd.shuffle(texts)
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]
    root = list(range(len(texts)))
    for j in range(len(texts)):
        for i in range(j):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    docs = samples.simple(spark, list(enumerate(texts)))
    kept = {r.doc_id for r in op.one_per_group(docs, **options).collect()}
    want = set(root)
    assert kept >= want and len(kept - want) <= 1  # a link is missed with a probability of 0.002


def test_fingerprints_differ_as_the_angle_says():
    rnd = np.random.default_rng(4)
    apart = []
    for _ in range(300):
        common = rnd.integers(0, 1 << 63, 800, np.uint64)
        pair = [np.unique(np.r_[common, rnd.integers(0, 1 << 63, 100, np.uint64)]) for _ in range(2)]  # 0.8
        bits = op.fingerprints(pair)
        apart.append(int(np.bitwise_count(bits[0] ^ bits[1]).sum()))
    assert abs(np.mean(apart) - op.BITS * np.arccos(8 / 9) / np.pi) < 2
    assert max(apart) <= op.CANDIDATE_BITS


def test_parts_skip_comparisons_but_lose_none():
    rnd = np.random.default_rng(2)
    for _ in range(60):
        base = [rnd.integers(0, 1 << 20, 40) for _ in range(4)]
        sets = []
        for _ in range(25):
            one = base[rnd.integers(4)].copy()
            one[rnd.integers(0, 40, rnd.integers(0, 6))] = rnd.integers(0, 1 << 20)
            sets.append(np.unique(one).astype(np.uint32))
        want = op.Parts(len(sets))
        for i in range(len(sets)):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                    want.join(np.array([i]), np.array([j]))
        assert op.similar_parts(sets, 0.8).label.tolist() == want.label.tolist()


def test_odd_rows(spark):
    docs = samples.documents(spark)
    kept = op.one_per_group(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert 1 in ids and not ids & {2, 3, 5, 6, 8}
    assert op.one_per_group(samples.empty(spark)).count() == 0


def test_workers_get_small_batches(spark, monkeypatch):
    """Pipeline, check of round 3: workers that held batches of 10,000 whole texts kept the room they took."""
    seen, stage = {}, op.stage

    def watched(df, name):
        seen[name] = df.sparkSession.conf.get(op.BATCH_SETTING)
        return stage(df, name)

    docs = samples.documents(spark)
    want = sorted(map(str, op.one_per_group(docs).collect()))
    monkeypatch.setattr(op, "stage", watched)
    monkeypatch.setattr(op, "BATCH_ROWS", 2)
    before = spark.conf.get(op.BATCH_SETTING)
    assert sorted(map(str, op.one_per_group(docs).collect())) == want
    assert {seen[n] for n in ("near-sketches", "near-candidates", "near-sets", "near-links")} == {"2"}
    assert spark.conf.get(op.BATCH_SETTING) == before
