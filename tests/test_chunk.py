import random

import models
import pytest
from pyspark.sql import functions as F

from lectern.operators import chunk
from lectern.plans.stages import documents_to_chunks



def sentence(length):
    """A sentence of so many characters with the blank after it."""
    return "Herons wade slowly through cold water below the old mill at dawn"[: length - 2].replace(" ", "-") + ". "


DOCS = {
    "doc1": sentence(26) * 10,
    "doc2": sentence(45) * 20,
    "doc3": "x" * 1000,
    "doc4": "Brief.",
    "doc5": (sentence(38) + sentence(28)) * 15,
}


def frame(spark, docs):
    return spark.createDataFrame(list(docs.items()), "doc_id string, text string").repartition(3)


def windows(df):
    rows = df.select("doc_id", "chunk_index", "char_start", "char_end", "chunk_text").collect()
    found = {}
    for row in sorted(rows):
        assert row["chunk_index"] == len(found.setdefault(row["doc_id"], []))
        found[row["doc_id"]].append((row["char_start"], row["char_end"], row["chunk_text"]))
    return found


def spans(df, doc="d"):
    return [(a, b) for a, b, _ in windows(df).get(doc, [])]


@pytest.mark.parametrize("size, overlap, total", [(512, 50, [1, 2, 3, 1, 3]), (256, 25, [2, 4, 5, 1, 5])])
def test_counts(spark, size, overlap, total):
    clean = {key: models.normalize(text) for key, text in DOCS.items()}
    found = windows(chunk.fixed_windows(frame(spark, clean), size, overlap))
    assert [len(found[key]) for key in DOCS] == total


def test_grid(spark):
    text = frame(spark, {"d": sentence(25) * 50})
    for (size, overlap), count in {(512, 50): 3, (256, 25): 6, (1024, 100): 2, (100, 10): 14}.items():
        found = windows(chunk.fixed_windows(text, size, overlap))["d"]
        assert len(found) == count and all(len(t) <= size for _, _, t in found)


def test_borders(spark):
    text = frame(spark, {"d": "x" * 100})
    assert spans(chunk.fixed_windows(text, 30, 5)) == [(0, 30), (25, 55), (50, 80), (75, 100)]
    assert spans(chunk.fixed_windows(text, 30, 40)) == [(0, 30), (30, 60), (60, 90), (90, 100)]
    assert chunk.fixed_windows(frame(spark, {"d": "", "e": "   \n\n\t  "})).count() == 0
    assert windows(chunk.fixed_windows(frame(spark, {"d": "Tiny texts"})))["d"] == [(0, 10, "Tiny texts")]
    with pytest.raises(ValueError):
        chunk.fixed_windows(text, 0, 0)


def test_offsets_reproduce_the_text(spark):
    text = "0123456789" * 10
    found = windows(chunk.fixed_windows(frame(spark, {"d": text}), 30, 5))["d"]
    assert all(text[a:b] == t for a, b, t in found)
    assert found[0][0] == 0 and found[-1][1] == len(text)
    assert all(b[0] == a[1] - 5 for a, b in zip(found, found[1:]))


def random_texts(seed, count):
    rnd = random.Random(seed)
    alphabets = ["ab .", " \n　a", "ab\U0001f600é", "abcdefgh ijklmnop" * 4 + ".!?", "  \n\t "]
    lengths = [0, 1, 5, 33, 100, 900, 1000, 1001, 1900, 1950, 2500, 6000]
    return {
        f"t{i:04}": "".join(rnd.choices(rnd.choice(alphabets), k=rnd.choice(lengths))) for i in range(count)
    }


@pytest.mark.parametrize("size, overlap", [(512, 50), (5, 2), (3, 0), (7, 6), (30, 40)])
def test_fixed_against_model(spark, size, overlap):
    texts = random_texts(1, 60)
    expected = {k: models.fixed(t, size, overlap) for k, t in texts.items()}
    assert windows(chunk.fixed_windows(frame(spark, texts), size, overlap)) == {k: w for k, w in expected.items() if w}


@pytest.mark.parametrize("size, overlap", [(1000, 100), (1000, 0), (300, 100), (250, 51), (50, 1)])
def test_sentences_against_model(spark, size, overlap):
    texts = random_texts(2, 80) | {"blanks": "x" * 700 + " " * 1200 + "b." * 300}
    expected = {k: models.sentences(t, size, overlap) for k, t in texts.items()}
    found = windows(chunk.sentence_windows(frame(spark, texts), size, overlap))
    assert found == {k: w for k, w in expected.items() if w}


def test_sentence_borders(spark):
    texts = {
        "fits": "a" * 999 + " ",
        "over": "a" * 1001,
        "at_end": "a" * 1000 + "." + "b" * 500,
        "outside": "a" * 800 + "." + "b" * 700,
        "tail": "a" * 1950,
    }
    df = chunk.sentence_windows(frame(spark, texts))
    found = windows(df)
    assert found["fits"] == [(0, 1000, texts["fits"])]
    assert [w[:2] for w in found["over"]] == [(0, 1000), (900, 1001)]
    assert found["at_end"][0][:2] == (0, 1001)
    assert found["outside"][0][:2] == (0, 1000)
    assert [w[:2] for w in found["tail"]] == [(0, 1000), (900, 1900), (1800, 1950)]
    totals = {r["doc_id"]: r["total_chunks"] for r in df.collect()}
    assert totals == {key: len(w) for key, w in found.items()}


def test_one_very_long_text(spark):
    text = spark.range(1).selectExpr("'d' AS doc_id", "repeat('lorem ipsum dolor. ', int(60000 + id)) AS text")
    length = 60000 * 19
    fixed = chunk.fixed_windows(text).agg(F.count("*").alias("n"), F.max("char_end").alias("end")).first()
    assert (fixed["n"], fixed["end"]) == (1 + -(-(length - 512) // 462), length)
    assert chunk.sentence_windows(text).agg(F.max("char_end")).first()[0] == length


def test_strategies_and_schema(spark):
    docs = frame(spark, DOCS).withColumn("source_path", F.concat(F.lit("/in/"), "doc_id"))
    chunks = chunk.chunk_documents(docs, "fixed", carry=["source_path"])
    assert chunks.columns == [
        "chunk_id", "doc_id", "chunk_text", "chunk_index", "char_start", "char_end", "token_count",
        "chunking_strategy", "source_path",
    ]
    ids = [row["chunk_id"] for row in chunks.collect()]
    assert len(set(ids)) == len(ids)
    again = [row["chunk_id"] for row in chunk.chunk_documents(docs.repartition(2), "fixed").collect()]
    assert sorted(ids) == sorted(again)
    assert {r["chunking_strategy"] for r in chunk.chunk_documents(docs, "semantic").collect()} == {"semantic"}
    with pytest.raises(NotImplementedError):
        chunk.chunk_documents(docs, "topical")


def test_enrich_keeps_chunks_without_document(spark):
    chunks = chunk.chunk_documents(frame(spark, DOCS))
    known = spark.createDataFrame([("doc1", "a"), ("doc2", "b")], "doc_id string, source_path string")
    rows = chunk.enrich_chunks(chunks, known, ["source_path"]).collect()
    assert len(rows) == chunks.count()
    assert all((r["source_path"] is None) == (r["doc_id"] not in ("doc1", "doc2")) for r in rows)


def test_windows_are_evaluated_once_and_without_shuffle(spark):
    for strategy in chunk.STRATEGIES:
        plan = chunk.chunk_documents(frame(spark, DOCS).coalesce(1), strategy)._jdf.queryExecution().executedPlan().toString()
        body = plan.split("RoundRobin")[0]
        assert "Exchange hash" not in plan and "Python" not in plan
        assert body.count("(?s)") == 1


def test_uneven_chunks_are_split_when_joined(spark, folder):
    """A document that holds a third of all chunks: adaptive execution cuts its partition."""
    made = spark.range(0, 12000, 1, 12).selectExpr(
        "IF(id % 3 = 0, 7, id % 40) AS doc_id", "sha2(string(id), 512) AS chunk_text"
    )
    made.write.parquet(f"{folder}/chunks")
    spark.range(40).selectExpr("id AS doc_id", "uuid() AS source_path").write.parquet(f"{folder}/docs")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.files.maxPartitionBytes": "30k",
    }
    session = spark.newSession()
    for key, value in settings.items():
        session.conf.set(key, value)
    chunks = session.read.parquet(f"{folder}/chunks")
    joined = chunk.enrich_chunks(chunks, session.read.parquet(f"{folder}/docs"), ["source_path"])
    rows = joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert len(rows) == chunks.count() and all(r["source_path"] for r in rows)
    assert "skew=true" in plan


def test_documents_to_chunks_normalises_and_drops_copies(spark):
    docs = spark.createDataFrame(
        [(1, "same   text"), (2, "same text\n\n"), (3, "other")], "doc_id long, text string"
    )
    rows = documents_to_chunks(docs).select("doc_id", "chunk_text").collect()
    assert sorted(map(tuple, rows)) == [(1, "same text"), (3, "other")]
