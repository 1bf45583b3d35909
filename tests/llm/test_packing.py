from collections import Counter, defaultdict
from itertools import combinations

from hypothesis import given, settings, strategies as st
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lectern.llm import packing as op
from lectern.llm.queries import QUERIES, VOCABULARY
from tests.llm import samples


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 9), min_size=1, max_size=9), st.integers(1, 5))
def test_boundaries_leave_the_least_padding(histogram, buckets):
    lengths = sorted(histogram)

    def padding(edges):
        return sum(n * (min(e for e in edges if e >= length) - length) for length, n in histogram.items())

    edges, left = op.best_boundaries(lengths, [histogram[x] for x in lengths], buckets)
    choices = [
        (*c, lengths[-1]) for k in range(min(buckets, len(lengths))) for c in combinations(lengths[:-1], k)
    ]
    assert edges == sorted(edges) and edges[-1] == lengths[-1] and len(edges) <= buckets
    assert padding(edges) == left == min(map(padding, choices))


def test_no_lengths():
    assert op.best_boundaries([], []) == ([], 0)


def check(rows, lengths, max_tokens, buckets, batch_tokens):
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.start, r.n_tokens))
    for doc, parts in pieces.items():
        at = 0
        for start, n in sorted(parts):
            assert start == at and 1 <= n <= max_tokens
            at += n
        assert at == lengths[doc]
    assert set(pieces) == set(lengths)
    edges, _ = op.best_boundaries(*map(list, zip(*sorted(Counter(r.n_tokens for r in rows).items()), strict=True)), buckets)
    batches = defaultdict(list)
    for r in rows:
        assert r.padded_length == edges[r.bucket] == min(e for e in edges if e >= r.n_tokens)
        batches[r.bucket, r.batch].append(r.place)
    last = {b: max(n for c, n in batches if c == b) for b, _ in batches}
    for (bucket, batch), places in batches.items():
        room = max(1, batch_tokens // edges[bucket])
        assert sorted(places) == list(range(len(places)))
        assert len(places) == room or batch == last[bucket] and len(places) <= room


def test_pack_a_table(spark):
    pairs = [(i, samples.words(i, 1 + i * i % 97)) for i in range(400)] + [(1000, samples.words(1, 900))]
    docs = samples.simple(spark, pairs, 6)
    rows = op.pack(docs, max_tokens=128, buckets=4, batch_tokens=512).collect()
    check(rows, {i: len(t.split()) + 1 for i, t in pairs}, 128, 4, 512)
    again = op.pack(docs.repartition(2), max_tokens=128, buckets=4, batch_tokens=512).collect()
    assert sorted(rows) == sorted(again)


def test_batches_follow_a_given_order(spark):
    docs = samples.simple(spark, [(i, "a b c") for i in range(50)])
    rows = op.pack(docs, order=[-F.col("doc_id")], batch_tokens=16).collect()
    assert [r.doc_id for r in sorted(rows, key=lambda r: (r.batch, r.place))] == list(range(49, -1, -1))


def test_odd_rows(spark):
    rows = op.pack(samples.documents(spark), max_tokens=1000).collect()
    tokens = Counter()
    for r in rows:
        tokens[r.doc_id] += r.n_tokens
    want = Counter()
    for r in samples.rows():
        want[r[0]] += len((r[1] or "").split()) + 1
    assert tokens == want
    assert op.pack(samples.empty(spark)).count() == 0


def test_the_query_and_the_stage_cut_and_budget_by_tokens(spark, folder):
    pairs = [(i, samples.words(i, 1 + i % 50)) for i in range(40)] + [(50, "漢字かな" * 3000), (51, "aGVsbG8" * 2000), (52, None), (53, "")]
    samples.simple(spark, pairs).write.parquet(f"{folder}/documents.parquet")
    tokenizer = Tokenizer.from_file(str(public_tokenizers.path(VOCABULARY)))
    lengths = {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in pairs}
    assert lengths[50] > op.MAX_TOKENS and lengths[51] > op.MAX_TOKENS
    check(QUERIES["op4_length_buckets"](spark, folder).collect(), lengths, op.MAX_TOKENS, op.BUCKETS, op.BATCH_TOKENS)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = corpus_pipeline.pack_batches(spark, docs, folder).collect()
    check(rows, lengths, op.MAX_TOKENS, op.BUCKETS, op.BATCH_TOKENS)


def test_counting_hands_small_batches_to_workers(spark, monkeypatch):
    """The setting holds while texts are counted, and is put back; counts do not depend on it."""
    seen, kept = [], op.stage

    def watched(df, name):
        seen.append(df.sparkSession.conf.get(op.BATCH_SETTING))
        return kept(df, name)

    monkeypatch.setattr(op, "stage", watched)
    monkeypatch.setattr(op, "BATCH_ROWS", 2)
    before = spark.conf.get(op.BATCH_SETTING)
    docs = spark.createDataFrame([(i, "some words " * i) for i in range(7)], "doc_id long, text string")
    rows, _ = op.counted(docs, public_tokenizers.path("byte_bpe_50k.json"))
    assert seen == ["2"] and spark.conf.get(op.BATCH_SETTING) == before
    assert {r["doc_id"]: r["n_tokens"] for r in rows.collect()}[0] == 1 and rows.count() == 7
