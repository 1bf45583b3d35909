"""Rows picked from stored tables where they lie, and tables replaced at once."""

import pytest
from pyspark.sql import functions as F

from checks import queries
from lectern.operators import places
from lectern.plans import indexing, stages
from lectern.sinks import tables as sink
from tests.test_index import FIRST, SECOND, corpus_of, documents


@pytest.fixture
def table(spark, folder):
    """Three files of some thousand rows, with repeated and null keys."""
    rows = spark.range(0, 15_000, 1, 3).select(
        F.when(F.col("id") % 100 != 7, F.col("id") % 6_000).alias("key"), F.col("id").alias("number"), F.lit("x").alias("_other")
    )
    rows.write.parquet(f"{folder}/table")
    return spark.read.parquet(f"{folder}/table")


def numbers(df):
    return sorted(r["number"] for r in df.collect())


@pytest.mark.parametrize("inside", [True, False])
def test_picked_rows_are_those_of_the_join(spark, table, monkeypatch, inside):
    monkeypatch.setattr(places, "fits", lambda df: inside)
    wanted = spark.createDataFrame([(k,) for k in [None, 1, 1, 5_999, 70_000, *range(0, 6_000, 3)]], "key long")
    expected = numbers(table.join(wanted, "key", "left_semi"))
    found = places.among(table, wanted, "key")
    assert found.columns == table.columns and numbers(found) == expected
    marked = places.marks(places.places(table, "key").join(wanted, "key", "left_semi"))
    assert places.marked_rows(marked) == len(expected) and numbers(places.picked(table, marked)) == expected
    few = table.where("number % 2 = 0").select("number", "key")  # not the whole table as it is stored
    some = places.marks(places.places(few, "key").join(wanted, "key", "left_anti"))
    assert numbers(places.picked(few, some)) == numbers(few.join(wanted, "key", "left_anti"))
    assert numbers(places.picked(table, places.marks(places.places(table, "key").limit(0)))) == []
    assert "SortMergeJoin" not in places.picked(table, marked)._jdf.queryExecution().sparkPlan().toString() or not inside


@pytest.mark.parametrize("large", [(), ("_comes",), ("NOT _comes",), ("_comes", "NOT _comes")])
def test_rows_are_split_off_by_the_smaller_side(spark, table, monkeypatch, large):
    keys = table.where("key IS NOT NULL").select("key").distinct().withColumn("_comes", F.col("key") % 7 == 0)
    wanted, others = keys.where("_comes"), keys.where("NOT _comes")
    sides = {"_comes": wanted, "NOT _comes": others}
    monkeypatch.setattr(places, "fits", lambda df: not any(sides[name] is df for name in large))
    found = places.split_off(table, "key", wanted, others)
    assert found.columns == table.columns
    assert numbers(found) == [n for n in range(15_000) if n % 100 != 7 and n % 6_000 % 7 == 0]


def test_texts_are_staged_for_no_delivery(spark, folder, monkeypatch):
    """Neither when a corpus is changed nor when its index is; and entries are shuffled by list only."""
    corpus, path = corpus_of(spark, folder, FIRST), f"{folder}/index"
    staged = []
    for module in (stages, indexing, places):
        monkeypatch.setattr(module, "stage", lambda df, *more, real=module.stage: staged.append(df.columns) or real(df, *more))
    plans, write = [], indexing._write_entries
    monkeypatch.setattr(indexing, "_write_entries", lambda *a: plans.append(a[0]) or write(*a))
    indexing.build_index(spark, corpus, path, indexing.FLAT)
    stages.apply_changes(spark, corpus, documents(spark, SECOND))
    merged = indexing.merge_index(spark, corpus, path)
    assert staged and not any({"text", "chunk_text"} & set(columns) for columns in staged)
    assert len(plans) == 2 and all(plans)
    texts = {r["chunk_text"] for r in merged.entries.select("chunk_text").collect()}
    assert texts == {t for _, t in SECOND}


def test_many_tombstones_are_not_sent_to_the_entries(spark, folder, monkeypatch):
    corpus, path = corpus_of(spark, folder, FIRST), f"{folder}/index"
    indexing.build_index(spark, corpus, path, indexing.FLAT)
    stages.apply_changes(spark, corpus, documents(spark, SECOND))
    for share in (10.0, 0.0):
        index = indexing.merge_index(spark, corpus, path, compact_share=share)
        expected = sorted(r["chunk_text"] for r in index.entries.collect())
        monkeypatch.setattr(indexing, "fits", lambda df: False)
        index = indexing.load_index(spark, path)
        assert sorted(r["chunk_text"] for r in index.entries.collect()) == expected == sorted(t for _, t in SECOND)
        monkeypatch.undo()
        stages.apply_changes(spark, corpus, documents(spark, FIRST))
        indexing.merge_index(spark, corpus, path, compact_share=share)
        stages.apply_changes(spark, corpus, documents(spark, SECOND))


def test_a_change_broken_off_leaves_the_tables_as_they_were(spark, folder, monkeypatch):
    corpus = corpus_of(spark, folder, FIRST[:30])
    content = lambda: (sorted(r["text"] for r in spark.read.parquet(corpus.documents).collect()), sorted(r["chunk_text"] for r in spark.read.parquet(corpus.chunks).collect()))
    before = content()

    def fail(*args):
        raise RuntimeError("broken off")

    with monkeypatch.context() as patched:
        patched.setattr(sink, "replace_chunks", fail)
        with pytest.raises(RuntimeError):
            stages.apply_changes(spark, corpus, documents(spark, SECOND[:30]))
    assert content() == before
    incoming = spark.read.parquet(corpus.documents).where("doc_id <> 'd3'")  # read from the table that is replaced
    stages.apply_changes(spark, corpus, incoming)
    assert content() == (sorted(t for i, t in FIRST[:30] if i != "d3"),) * 2
    assert spark.read.parquet(corpus.embeddings).count() == 29


@pytest.mark.parametrize("limit", [2_000_000, 0])
def test_a_delivery_meets_repeated_and_missing_labels(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(queries, "LABELS", limit)
    docs = [(i, f"text {i}", "s") for i in range(8)] + [(2, "text 2", "s"), (None, "none", "s")]
    spark.createDataFrame(docs, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(0, 1, 0), (1, 0, 1), (2, 0, 0), (2, 1, 0), (3, None, 1), (None, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    corpus, second = queries._first_delivery(spark, str(tmp_path))
    by_text = lambda df: sorted(r["text"] for r in df.collect())
    unlabelled = [f"text {i}" for i in range(4, 8)]
    assert by_text(spark.read.parquet(corpus.documents)) == sorted(["none", "text 1", "text 2", "text 2", "text 3", *unlabelled])
    assert by_text(second) == sorted(["none edited", "text 0", *["text 2"] * 4, *[f"{t} edited" for t in unlabelled]])
