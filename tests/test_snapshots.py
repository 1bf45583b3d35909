"""A corpus in versions: a delivery appears all at once or not at all."""

import pytest

from lectern.plans import snapshots, stages
from lectern.sinks import tables as sink
from tests.test_index import FIRST, SECOND, documents


def content(spark, corpus):
    docs = sorted((r["source_path"], r["text"]) for r in spark.read.parquet(corpus.documents).collect())
    chunks = {r["chunk_id"]: r["chunk_text"] for r in spark.read.parquet(corpus.chunks).collect()}
    vectors = {r["chunk_id"] for r in snapshots.vectors(spark, corpus).collect()}
    places = [r["embedding_index"] for r in spark.read.parquet(corpus.positions).orderBy("embedding_index").collect()]
    assert vectors == set(chunks) and places == list(range(len(chunks)))
    assert sorted(chunks.values()) == sorted(t for _, t in docs)  # short texts: one chunk each
    return docs


def wanted(rows):
    return sorted((f"path/{i}", t) for i, t in rows)


@pytest.mark.parametrize("broken", ["write_documents", "write_embeddings", "write_json"])
def test_a_delivery_broken_off_leaves_the_version_before(spark, folder, monkeypatch, broken):
    first, second = FIRST[:12], SECOND[:14]
    snapshots.deliver(spark, folder, documents(spark, first))
    assert content(spark, snapshots.load_corpus(spark, folder)) == wanted(first)
    real = getattr(sink, broken)

    def fail(rows, path, *more, **options):
        if broken == "write_json" and "/manifest/" not in path:  # metrics lie beside the tables
            return real(rows, path, *more, **options)
        if broken != "write_json":
            real(rows, path, *more, **options)
        raise RuntimeError("broken off")

    with monkeypatch.context() as patched:
        patched.setattr(sink, broken, fail)
        with pytest.raises(RuntimeError):
            snapshots.deliver(spark, folder, documents(spark, second))
    left = snapshots.load_corpus(spark, folder)
    assert left.version == 0 and content(spark, left) == wanted(first)
    done = snapshots.deliver(spark, folder, documents(spark, second))
    assert done.version == 1 and content(spark, snapshots.load_corpus(spark, folder)) == wanted(second)
    assert content(spark, snapshots.load_corpus(spark, folder, 0)) == wanted(first)  # the old version still reads
    assert [(r["version"], r["parent"], r["documents"]) for r in snapshots.versions(spark, folder).orderBy("version").collect()] == [(0, None, 12), (1, 0, 14)]


def test_nothing_there(spark, folder):
    with pytest.raises(FileNotFoundError):
        snapshots.load_corpus(spark, folder)
    assert snapshots.versions(spark, folder).count() == 0
    with pytest.raises(FileNotFoundError):
        snapshots.load_corpus(spark, folder, 3)


def test_a_corpus_without_versions_stays_as_it_was():
    corpus = stages.Corpus("/data/corpus/")
    assert (corpus.documents, corpus.chunks, corpus.embeddings) == ("/data/corpus/documents", "/data/corpus/chunks", "/data/corpus/embeddings")
    versioned = stages.Corpus("/data/corpus", 3)
    assert versioned.documents == "/data/corpus/versions/00000003/documents" and versioned.embeddings == corpus.embeddings
