"""Duplicates, resume, order, changes."""

import pytest
from pyspark.sql import functions as F

from lectern.functions.text import content_hash
from lectern.operators import dedup, metrics, ordering


def hashed(spark, rows):
    return spark.createDataFrame(rows, "source_path string, text string").withColumn("hash", content_hash("text"))


def test_five_files(spark):
    files = [("original.txt", "same")] + [(f"copy{i}.txt", "same") for i in range(3)] + [("different.txt", "x")]
    df = hashed(spark, files)
    assert {r["source_path"] for r in dedup.drop_duplicates(df, "source_path").collect()} == {"copy0.txt", "different.txt"}
    assert tuple(dedup.duplicate_stats(df).first()) == (5, 2, 3)


@pytest.mark.parametrize("bound", [0, 1000])
def test_survivor_does_not_depend_on_order(spark, bound):
    """A third of all rows are copies of one text."""
    rows = [(f"p{i:03}", f"text {i % 7 if i % 3 else 0}") for i in range(200)]
    first = sorted(dedup.drop_duplicates(hashed(spark, rows), "source_path", broadcast_rows=bound).collect())
    again = hashed(spark, rows[::-1]).repartition(7)
    assert first == sorted(dedup.drop_duplicates(again, "source_path", broadcast_rows=bound).collect())
    smallest = {}
    for path, text in rows:
        smallest.setdefault(text, path)
    assert {(r["source_path"], r["text"]) for r in first} == {(p, t) for t, p in smallest.items()}


def test_texts_of_copies_are_not_gathered_by_hash(spark):
    """Only keys are grouped by hash; whole rows move by their unique key, if at all."""
    df = hashed(spark, [("a", "x"), ("b", "x")])
    plan = dedup.survivors(df.select("source_path", "hash"), "source_path")._jdf.queryExecution().optimizedPlan()
    assert plan.output().mkString(",").count("text") == 0


def test_empty_stats(spark):
    assert tuple(dedup.duplicate_stats(hashed(spark, [])).first()) == (0, 0, 0)


def test_not_yet_stored(spark):
    df = hashed(spark, [(f"p{i}", f"t{i}") for i in range(10)])
    stored = df.where("source_path < 'p4'")
    assert sorted(r["source_path"] for r in dedup.not_yet_stored(df, stored).collect()) == [f"p{i}" for i in range(4, 10)]
    assert dedup.not_yet_stored(df, df).count() == 0


def test_changes(spark):
    old = hashed(spark, [("same", "1"), ("changed", "1"), ("gone", "1")])
    new = hashed(spark, [("same", "1"), ("changed", "2"), ("new", "1")])
    status = {r["source_path"]: r["status"] for r in dedup.changes(old, new).collect()}
    assert status == {"same": "same", "changed": "changed", "gone": "deleted", "new": "new"}


@pytest.mark.parametrize("partitions", [1, 6])
def test_dense_index(spark, partitions):
    keys = [f"{(i * 7919) % 1000:04}" for i in range(1000)]
    df = spark.createDataFrame([(k,) for k in keys], "key string").repartition(partitions)
    rows = ordering.dense_index(df, "key").collect()
    assert sorted((r["position"], r["key"]) for r in rows) == list(enumerate(sorted(keys)))


def test_pages_and_batches(spark):
    df = spark.range(25).withColumn("text", F.concat(F.lit("t"), "id"))
    assert sorted(r["id"] for r in ordering.page_of_rows(df, "id", 10, 10).collect()) == list(range(10, 20))
    assert sorted(r["id"] for r in ordering.page_of_rows(df, "id", 20, 10).collect()) == list(range(20, 25))
    assert ordering.page_of_rows(df, "id", 30, 10).count() == 0
    batches = {r["id"]: r["batch"] for r in ordering.write_batches(df, "id", 10).collect()}
    assert batches == {i: i // 10 for i in range(25)}


def test_latest_checkpoint(spark):
    names = spark.createDataFrame([(n,) for n in ["checkpoint_2", "checkpoint_10", "part_99", "checkpoint_x"]], "name string")
    assert tuple(metrics.latest_checkpoint(names).first()) == ("checkpoint_10", 10)
