from collections import Counter
from fractions import Fraction

import pytest
from hypothesis import given, settings, strategies as st

from lectern.llm import mixing as op
from tests.llm import samples


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=9))
def test_windows_are_met_and_no_source_strays_by_a_block(parts):
    period = sum(parts)
    rows = op.windows(parts)
    assert [r[4] for r in rows] == list(range(period))
    assert Counter(r[0] for r in rows) == dict(enumerate(parts))
    done = [0] * len(parts)
    for stream, block, release, deadline, slot in rows:
        assert block == done[stream] and release <= slot < deadline
        done[stream] += 1
        for s, n in enumerate(done):
            assert abs(n - Fraction((slot + 1) * parts[s], period)) < 1


@settings(max_examples=100, deadline=None)
@given(st.lists(st.floats(1e-6, 1e6), min_size=1, max_size=50))
def test_whole_parts(weights):
    parts = op.whole_parts(weights, 1000)
    assert sum(parts) == 1000 and min(parts) >= 1


def test_bad_weights():
    for weights in ([], [1.0, 0.0], [-1.0], [1.0] * 11):
        with pytest.raises(ValueError):
            op.whole_parts(weights, 10)


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def test_mix_of_a_table(spark):
    docs = spark.createDataFrame(
        [(i, "abcd"[min(3, i * 7 % 10 // 2)] if i % 97 else None, "t") for i in range(3000)],
        "doc_id long, source string, slot string",
    ).repartition(7)
    weights = {"a": 3.0, "b": 1.0, "c": 1.0}
    rows = rows_of(op.mix(docs, weights, 0.5, block_documents=16, period=11))
    assert sorted(r["doc_id"] for r in rows) == list(range(3000))
    assert len({(r["slot"], r["place"]) for r in rows}) == 3000
    names = ["a", "b", "c", None]
    parts = op.whole_parts([3.0, 1.0, 1.0, 0.5], 11)
    stream = lambda s: names.index(s) if s in weights else 3  # noqa: E731  d and null share one stream
    counts = Counter(stream(r["source"]) for r in rows)
    per_slot = {}
    for r in rows:
        assert r["release"] <= r["slot"] < r["deadline"]
        assert per_slot.setdefault(r["slot"], stream(r["source"])) == stream(r["source"])
        s, p = stream(r["source"]), parts[stream(r["source"])]
        assert r["release"] == r["block"] * 11 // p and r["deadline"] == -(-(r["block"] + 1) * 11 // p)
        assert 0 <= r["place"] < 16 and r["block"] <= (counts[s] - 1) // 16
    first_gap = min(set(range(max(per_slot) + 2)) - set(per_slot))
    done = Counter()
    for slot in range(first_gap):
        done[per_slot[slot]] += 1
        assert all(abs(done[s] - Fraction((slot + 1) * p, 11)) < 1 for s, p in enumerate(parts))
    assert first_gap > 20
    again = rows_of(op.mix(docs.repartition(3), weights, 0.5, block_documents=16, period=11))
    key = lambda r: r["doc_id"]
    assert sorted(rows, key=key) == sorted(again, key=key)


def test_weights_by_size(spark):
    docs = spark.createDataFrame([(i, "a" if i < 64 else f"s{i}") for i in range(80)], "doc_id long, source string")
    weights, rest = op.size_weights(docs, exponent=0.5, at_most=2)
    assert weights["a"] == 8.0 and len(weights) == 2 and rest == 15**0.5


def test_odd_rows_and_written_order(spark, folder):
    docs = samples.documents(spark)
    rows = rows_of(op.mix(docs, block_documents=2))
    want = {(r[0], r[3]) for r in samples.rows()}
    assert len(rows) == len(want) and {(r["doc_id"], r["source"]) for r in rows} == want
    ordered = op.in_mix_order(docs, block_documents=2)
    assert ordered.columns == docs.columns
    ordered.write.parquet(f"{folder}/mixed")
    place = {(r["doc_id"], r["source"]): (r["slot"], r["place"]) for r in rows}
    written = []
    for path in sorted(p for p in spark.read.parquet(f"{folder}/mixed").inputFiles()):
        written += [place[r.doc_id, r.source] for r in spark.read.parquet(path).collect()]
    assert len(written) == len(samples.rows()) and written == sorted(written)
    assert op.mix(samples.empty(spark)).count() == 0
    assert op.in_mix_order(samples.empty(spark)).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.floats(1e-3, 1e3), st.integers(0, 30)), min_size=1, max_size=12))
def test_windows_hold_for_exact_weights(streams):
    weights, blocks = [w for w, _ in streams], [n for _, n in streams]
    total = sum(map(Fraction, weights))
    exact = [Fraction(w) / total for w in weights]
    rows = list(op.schedule(op.exact_parts(weights), blocks))
    assert Counter(r[0] for r in rows) == {s: n for s, n in enumerate(blocks) if n}
    assert len({r[4] for r in rows}) == len(rows)
    for s, block, release, deadline, slot in rows:
        assert release == block // exact[s] and deadline == -(-(block + 1) // exact[s])
        assert release <= slot < deadline


def test_no_source_drifts_from_its_unrounded_weight(spark):
    docs = spark.createDataFrame([(i, f"s{i % 40 if i % 3 else 0}") for i in range(30_000)], "doc_id long, source string")
    rows = op.mix(docs, block_documents=1).select("source", "slot", "block", "release", "deadline").collect()
    n = Counter(r.source for r in rows)
    total = sum(Fraction(x**0.5) for x in n.values())
    assert len({r.slot for r in rows}) == len(rows) == 30_000
    for r in rows:
        weight = Fraction(n[r.source] ** 0.5) / total
        assert r.release == r.block // weight and r.deadline == -(-(r.block + 1) // weight)
        assert r.release <= r.slot < r.deadline


def test_every_source_has_its_own_weight_however_many_there_are(spark):
    docs = spark.createDataFrame([(i, f"s{i % 12_000}" if i < 26_000 else None) for i in range(26_050)], "doc_id long, source string")
    rows = op.mix(docs, block_documents=1).select("source", "slot", "block", "release", "deadline").collect()
    n = Counter(r.source for r in rows)
    total = sum(Fraction(x**0.5) for x in n.values())
    assert len(n) == 12_001 and len({r.slot for r in rows}) == len(rows) == 26_050
    weights = {s: Fraction(x**0.5) / total for s, x in n.items()}
    for r in rows:
        assert r.block < n[r.source] and r.release == r.block // weights[r.source]
        assert r.release <= r.slot < r.deadline == -(-(r.block + 1) // weights[r.source])
