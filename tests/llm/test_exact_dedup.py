import hashlib
from collections import defaultdict

import pytest

from lectern.llm import exact_dedup as op
from tests.llm import samples


def expected(pairs):
    """A row per row of the table, as the query's SQL has it."""
    groups = defaultdict(list)
    for doc_id, text in pairs:
        groups[samples.lower(text)].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return out


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
def test_against_brute_force(spark, broadcast_rows):
    docs = samples.documents(spark)
    result = op.text_digests(docs, op.exact_duplicates(docs, broadcast_rows=broadcast_rows))
    got = [tuple(r) for r in result.collect()]
    assert sorted(got, key=repr) == sorted(expected([(r[0], r[1]) for r in samples.rows()]), key=repr)


def test_repeated_rows_count_and_come_back(spark):
    rows = [(1, "Aa"), (1, "Aa"), (2, "aa"), (3, "b"), (3, "b"), (None, None), (None, "")]
    docs = samples.simple(spark, rows)
    got = [tuple(r) for r in op.text_digests(docs, op.exact_duplicates(docs)).collect()]
    assert sorted(got, key=repr) == sorted(expected(rows), key=repr)
    assert sorted(r[:4] for r in got if r[0] in (1, 2)) == [(1, 2, 3, False), (1, 2, 3, False), (2, 2, 3, True)]


def test_columns_named_as_those_made_inside_stay(spark):
    docs = spark.createDataFrame(
        [(1, "x", 5, "p", 6.0, 7), (2, "X", 8, "q", 9.0, 1), (3, "y", 2, "r", 3.0, 4)],
        "doc_id long, text string, __length int, __prefix string, __row double, __keep int",
    )
    assert sorted(map(tuple, op.drop_copies(docs).collect())) == [(2, "X", 8, "q", 9.0, 1), (3, "y", 2, "r", 3.0, 4)]


def test_texts_that_share_their_beginning_are_told_apart(spark):
    docs = samples.documents(spark)
    got = {tuple(r)[:4] for r in op.exact_duplicates(docs, prefix_chars=1).collect()}
    assert got == {w[:4] for w in expected([(r[0], r[1]) for r in samples.rows()])}


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
def test_drop_copies_keeps_one_row_per_text(spark, broadcast_rows):
    docs = samples.documents(spark)
    kept = op.drop_copies(docs, broadcast_rows=broadcast_rows)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id or -1), samples.lower(r.text)) for r in kept.collect())
    want = expected([(r[0], r[1]) for r in samples.rows()])
    by_hash = {hashlib.sha256(samples.lower(r[1]).encode()).hexdigest(): samples.lower(r[1]) for r in samples.rows()}
    assert got == sorted({((i or -1), by_hash[h]) for i, _, _, stays, h in want if stays})


def test_same_id_with_two_texts_is_two_documents(spark):
    docs = samples.simple(spark, [(1, "a"), (1, "b"), (2, "A")])
    got = {(r.doc_id, r.keep_id, r.group_size) for r in op.exact_duplicates(docs).collect()}
    assert got == {(1, 2, 2), (2, 2, 2), (1, 1, 1)}
    assert sorted((r.doc_id, r.text) for r in op.drop_copies(docs).collect()) == [(1, "b"), (2, "A")]


def test_empty_table(spark):
    docs = samples.empty(spark)
    assert op.exact_duplicates(docs).count() == 0
    assert op.drop_copies(docs).count() == 0


def test_no_python_in_the_plan(spark):
    docs = samples.documents(spark)
    plan = op.text_digests(docs, op.exact_duplicates(docs))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
