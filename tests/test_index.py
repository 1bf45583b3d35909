"""Inverted lists read by bounds, requests as rows, and an index that is brought up to date by versions."""

import glob
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.operators import ivf, nearest as nn, requests as asking, search
from lectern.plans import indexing, retrieval, stages
from lectern.session import stage
from lectern.sinks import tables as sink
from tests.test_vectors import brute, clustered, ranked, tables


def placed_lists(vectors, lists, rounds=2):
    centroids = stage(ivf.train_centroids(vectors, lists, rounds), "centroids")
    placed = stage(ivf.with_list(vectors, centroids), "placed")
    return centroids, placed, stage(centroids.join(ivf.list_extents(placed), "list_id", "left"), "extents")


# ---- lists ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 100])
def test_each_row_gets_its_nearest_centroid_in_place(spark, broadcast_bytes):
    data = clustered(300)
    vectors, _ = tables(spark, data, data[:1])
    centroids = stage(ivf.seed_centroids(vectors, 12), "centroids")
    wide = vectors.withColumn("kind", F.col("vec_id") % 3)
    got = ivf.with_list(wide, centroids, broadcast_bytes=broadcast_bytes).orderBy("vec_id").collect()
    centres = np.array([r["centroid"] for r in centroids.orderBy("list_id").collect()], float)
    square = ((data[:, None, :].astype(float) - centres[None]) ** 2).sum(-1)
    assert [r["list_id"] for r in got] == square.argmin(1).tolist()
    assert np.allclose([r["list_distance"] for r in got], square.min(1))
    assert [r["kind"] for r in got] == [i % 3 for i in range(300)]


def test_training_shuffles_no_vectors(spark):
    vectors, _ = tables(spark, clustered(200), clustered(1))
    centroids = stage(ivf.seed_centroids(vectors, 4), "centroids")
    plan = ivf.with_list(vectors, centroids)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") == 0 and "MapInArrow" in plan


@pytest.mark.parametrize("hot,first_probes", [(0.0, 4), (0.4, 1)])
def test_bounds_give_the_exact_neighbours(spark, hot, first_probes):
    data, asked = clustered(700, hot=hot), clustered(15, seed=7)
    vectors, queries = tables(spark, data, asked)
    _, placed, extents = placed_lists(vectors, 16)
    found = stage(ivf.search_exact(placed, extents, queries, 6, first_probes=first_probes), "found")
    assert ranked(found.drop("lists_read")) == brute(data, asked, 6)


def test_bounds_spare_most_lists_of_clustered_vectors(spark):
    data, asked = clustered(2000), clustered(40, seed=8)
    vectors, queries = tables(spark, data, asked)
    _, placed, extents = placed_lists(vectors, ivf.list_count(2000), rounds=4)
    found = stage(ivf.search_exact(placed, extents, queries, 10, first_probes=1), "found")
    assert ranked(found.drop("lists_read")) == brute(data, asked, 10)
    share = found.select("query_id", "lists_read").distinct().agg(F.avg("lists_read")).first()[0] / ivf.list_count(2000)
    assert share < 0.5


def test_parts_of_the_lists_and_more_results_than_vectors(spark):
    data, asked = clustered(60), clustered(5, seed=2)
    vectors, queries = tables(spark, data, asked)
    _, placed, extents = placed_lists(vectors, 9)
    parts = ivf.search_exact(placed, extents, queries, 4, first_probes=2, broadcast_bytes=300)
    assert ranked(parts.drop("lists_read")) == brute(data, asked, 4)
    assert ranked(ivf.search_exact(placed, extents, queries, 99).drop("lists_read")) == brute(data, asked, 60)
    assert ivf.search_exact(placed, extents.where("false"), queries, 4).count() == 0
    assert ivf.search_exact(placed, extents, queries.where("false"), 4).count() == 0


def test_filtered_lists_are_read_on_until_k_matches_are_certain(spark):
    data, asked = clustered(500), clustered(8, seed=11)
    vectors, queries = tables(spark, data, asked)
    _, placed, extents = placed_lists(vectors, 20)
    for every in (2, 83, 1000):
        rows = placed.where(F.col("vec_id") % every == 0)
        found = stage(ivf.search_exact(rows, extents, queries, 5, first_probes=1), "found")
        assert ranked(found.drop("lists_read")) == brute(data, asked, 5, set(range(0, 500, every)))


def test_probes_for_a_recall(spark):
    data = clustered(1500)
    vectors, _ = tables(spark, data, data[:1])
    centroids, placed, _ = placed_lists(vectors, 30)
    chosen, recall = ivf.probes_for_recall(placed, centroids, 10, 0.95)
    assert 1 <= chosen < 30 and recall >= 0.95
    assert ivf.probes_for_recall(placed, centroids, 10, 0.05)[0] <= chosen
    asked = vectors.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    exact = stage(nn.nearest(vectors, asked, 10), "exact")
    found = ivf.search(placed.select("list_id", "vec_id", "embedding"), centroids, asked, 10, chosen)
    assert search.recall(exact, found, 10).agg(F.avg("recall")).first()[0] > 0.85


SF = "/root/testdata/sf0.1/embeddings.parquet"


@pytest.mark.skipif(not os.path.exists(SF), reason="tables are not there")
def test_recall_of_the_given_vectors(spark):
    vectors = spark.read.parquet(SF).select("vec_id", "embedding")
    centroids, placed, extents = placed_lists(vectors, ivf.list_count(vectors.count()), rounds=ivf.TRAINING_ROUNDS)
    asked = vectors.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    exact = stage(nn.nearest(vectors, asked, 10), "exact")
    chosen, _ = ivf.probes_for_recall(placed, centroids)
    lists = placed.select("list_id", "vec_id", "embedding")
    probed = ivf.search(lists, centroids, asked, 10, chosen)
    assert search.recall(exact, probed, 10).agg(F.avg("recall")).first()[0] >= 0.88  # 0.9 on the sample
    whole = ivf.search_exact(lists, extents, asked, 10)
    assert search.recall(exact, whole, 10).agg(F.min("recall")).first()[0] == 1.0


# ---- requests ------------------------------------------------------------------------------------


def requests_of(queries, rows):
    table = queries.sparkSession.createDataFrame(rows, "query_id long, top_k int, filters string")
    return queries.join(table, "query_id")


CASES = [
    (0, 3, None),
    (1, None, '{"kind": "a"}'),
    (2, 20, '{"kind": ["a", "b"], "size": 1}'),
    (3, 1, "{}"),
    (4, 7, '{"kind": "zzz"}'),
    (5, 2, '{"size": "1"}'),
    (6, 4, '{"kind": null}'),
    (7, 0, None),
    (8, 21, '{"kind": "a"}'),
    (9, 5, "[1]"),
    (10, 5, "not json"),
    (11, 6, '{"kind": "a"}'),
]


def entries_of(vectors):
    kind = F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c"), F.lit(None)), (F.col("vec_id") % 4 + 1).cast("int"))
    return vectors.withColumn("kind", kind).withColumn("size", F.col("vec_id") % 2)


def expected_requests(data, asked):
    def allowed(filters):
        out = set()
        for i in range(len(data)):
            row = {"kind": ["a", "b", "c", None][i % 4], "size": i % 2}
            ok = True
            for key, value in json.loads(filters or "{}").items():
                wanted = value if isinstance(value, list) else [value]
                ok = ok and key in row and any(type(row[key]) is type(w) and row[key] == w for w in wanted)
            if ok:
                out.add(i)
        return out

    out = {}
    for q, top_k, filters in CASES[:7] + CASES[11:]:
        ids = brute(data, asked, top_k or 5, allowed(filters))[q]
        if ids:
            out[q] = ids
    return out


@pytest.mark.parametrize("lists", [False, True])
@pytest.mark.parametrize("at_once", [64, 2])
def test_requests_with_their_own_k_and_filters(spark, lists, at_once):
    data, asked = clustered(400), clustered(12, seed=3)
    vectors, queries = tables(spark, data, asked)
    _, placed, extents = placed_lists(vectors, 9)
    find = (lambda v, q, k: ivf.search_exact(v, extents, q, k, first_probes=1).drop("lists_read")) if lists else None
    good = asking.checked(requests_of(queries, CASES)).where("error IS NULL")
    found = asking.search_requests(entries_of(placed), good, find, at_once)
    assert ranked(found) == expected_requests(data, asked)


def test_cells_by_group_give_the_same(spark):
    data, asked = clustered(200), clustered(12, seed=3)
    vectors, queries = tables(spark, data, asked)
    good = asking.checked(requests_of(queries, CASES)).where("error IS NULL")
    found = asking.search_requests(entries_of(vectors), good, lambda v, q, k: asking.nearest_of_group(v, q, k, broadcast_bytes=1))
    assert ranked(found) == expected_requests(data, asked)


def test_rejected_requests(spark):
    _, queries = tables(spark, clustered(1), clustered(12))
    got = {r["query_id"]: r["error"] for r in asking.rejected(requests_of(queries, CASES)).collect()}
    out = "top_k must be between 1 and 20"
    assert got == {7: out, 8: out, 9: "filters must be a JSON object", 10: "filters must be a JSON object"}
    assert asking.rejected(queries).count() == 0  # neither column: the defaults
    assert asking.checked(queries).first()["k"] == 5


def test_no_requests(spark):
    vectors, queries = tables(spark, clustered(10), clustered(2))
    none = asking.checked(queries).where("false")
    assert asking.search_requests(entries_of(vectors), none).count() == 0


# ---- versions of an index ------------------------------------------------------------------------


def documents(spark, rows):
    return spark.createDataFrame(
        [(i, f"path/{i}", t, t, "txt", len(t), 1) for i, t in rows],
        "doc_id string, source_path string, text string, hash string, file_type string, file_size_bytes long, page_count int",
    ).withColumns({"ingestion_timestamp": F.lit(0).cast("timestamp"), "parser_version": F.lit("1")})


def sentence(i):
    return " ".join([f"item{i}", *(f"word{(i * 7 + j * j) % 50}" for j in range(12))])


def corpus_of(spark, folder, rows):
    corpus = stages.Corpus(f"{folder}/corpus")
    sink.write_documents(documents(spark, rows), corpus.documents)
    stages.chunk_corpus(spark, corpus, "fixed")
    stages.embed_corpus(spark, corpus)
    return corpus


FIRST = [(f"d{i}", sentence(i)) for i in range(160)]
SECOND = [(f"d{i}", sentence(i + 1000 if i % 9 == 0 else i)) for i in range(5, 170)]


def files_of(path, version):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{path}/entries/version={version}/list_id=*/*.parquet")}


def answers(index, spark):
    asked = retrieval.embed_queries(spark.createDataFrame([(i, sentence(i + 3)) for i in range(0, 60, 7)], "query_id long, query_text string"), index.model_name)
    rows = index.search(asked, 5, exact=True).orderBy("query_id", "rank").collect()
    return [(r["query_id"], r["rank"], r["vec_id"], r["source_path"], r["distance"]) for r in rows]


def live(index):
    return sorted((r["vec_id"], r["doc_id"], tuple(r["embedding"])) for r in index.entries.collect())


@pytest.mark.parametrize(
    "kind,share", [(indexing.INVERTED, 0.0), (indexing.INVERTED, 10.0), (indexing.HASHED_BUCKETS, 0.0), (indexing.FLAT, 10.0)]
)
def test_a_merged_index_answers_as_one_built_afresh(spark, folder, kind, share):
    corpus, path = corpus_of(spark, folder, FIRST), f"{folder}/index"
    indexing.build_index(spark, corpus, path, kind)
    before, old = files_of(path, 0), indexing.load_index(spark, path)
    old_answers = answers(old, spark)
    stages.apply_changes(spark, corpus, documents(spark, SECOND))
    merged = indexing.merge_index(spark, corpus, path, compact_share=share)
    indexing.build_index(spark, corpus, f"{folder}/afresh", kind)
    afresh = indexing.load_index(spark, f"{folder}/afresh")
    assert merged.version == 1 and live(merged) == live(afresh)
    assert answers(merged, spark) == answers(afresh, spark) != old_answers
    assert files_of(path, 0) == before  # nothing written before is touched
    sizes = {r["list_id"]: r["count"] for r in merged.entries.groupBy("list_id").count().collect()}
    assert {r["list_id"]: r["size"] for r in merged.lists.where("size > 0").collect()} == sizes
    rewritten = {r["list_id"] for r in merged.lists.where("base = 1").collect()}
    assert bool(rewritten) == (share == 0.0)
    assert tuple(merged.stats().first()) == (len(live(merged)), kind, merged.dim)
    assert answers(indexing.load_index(spark, path, version=0), spark) == old_answers  # the old version still reads
    assert indexing.merge_index(spark, corpus, path).version == 1  # the second time changes nothing


def test_what_goes_and_comes_back_is_live_again(spark, folder):
    corpus, path = corpus_of(spark, folder, FIRST[:60]), f"{folder}/index"
    indexing.build_index(spark, corpus, path, indexing.INVERTED)
    first = live(indexing.load_index(spark, path))
    for rows in (FIRST[20:60], FIRST[:60]):
        stages.apply_changes(spark, corpus, documents(spark, rows))
        assert len(live(indexing.merge_index(spark, corpus, path, compact_share=0.6))) == len(rows)
    assert live(indexing.load_index(spark, path)) == first


@pytest.mark.parametrize("broken", ["_write_entries", "_commit"])
def test_a_run_broken_off_leaves_the_version_before_it(spark, folder, monkeypatch, broken):
    corpus, path = corpus_of(spark, folder, FIRST[:80]), f"{folder}/index"
    indexing.build_index(spark, corpus, path, indexing.INVERTED)
    before = live(indexing.load_index(spark, path))
    stages.apply_changes(spark, corpus, documents(spark, FIRST[30:110]))
    real = getattr(indexing, broken)

    def fail(*args):
        if broken == "_write_entries":
            real(*args)  # the files are there, but no version names them
        raise RuntimeError("broken off")

    with monkeypatch.context() as patched:
        patched.setattr(indexing, broken, fail)
        with pytest.raises(RuntimeError):
            if broken == "_commit":
                indexing.build_index(spark, corpus, path, indexing.FLAT)
            else:
                indexing.merge_index(spark, corpus, path)
        again = indexing.load_index(spark, path)
        assert again.version == 0 and again.index_type == indexing.INVERTED and live(again) == before
    merged = indexing.merge_index(spark, corpus, path)
    assert merged.version == 1 and len(live(merged)) == 80


def test_a_rebuilt_index_is_a_version_of_its_own(spark, folder):
    corpus, path = corpus_of(spark, folder, FIRST[:80]), f"{folder}/index"
    indexing.build_index(spark, corpus, path, indexing.HASHED_BUCKETS)
    indexing.build_index(spark, corpus, path, indexing.INVERTED)
    index = indexing.load_index(spark, path)
    assert (index.version, index.index_type) == (1, indexing.INVERTED) and len(live(index)) == 80
    assert index.recall >= indexing.TARGET_RECALL and index.nprobe >= 1
    with pytest.raises(FileNotFoundError):
        indexing.load_index(spark, path, version=7)


def test_requests_against_a_stored_index(spark, folder):
    corpus, path = corpus_of(spark, folder, FIRST), f"{folder}/index"
    asked = spark.createDataFrame(
        [(1, sentence(5), 3, None), (2, sentence(9), None, '{"source_path": ["path/d9", "path/d11"]}'), (3, sentence(1), 30, None)],
        "query_id long, query_text string, top_k int, filters string",
    )
    got = {}
    for kind in (indexing.FLAT, indexing.INVERTED):
        indexing.build_index(spark, corpus, path, kind)
        found, bad = retrieval.retrieve_requests(indexing.load_index(spark, path), asked)
        assert [r["query_id"] for r in bad.collect()] == [3]
        got[kind] = sorted((r["query_id"], r["rank"], r["source_path"], r["similarity_score"]) for r in found.collect())
    assert got[indexing.FLAT] == got[indexing.INVERTED]
    assert [(q, n) for q, n, *_ in got[indexing.FLAT]] == [(1, 1), (1, 2), (1, 3), (2, 1), (2, 2)]
    assert {p for q, _, p, _ in got[indexing.FLAT] if q == 2} == {"path/d9", "path/d11"}
