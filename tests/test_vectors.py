"""Nearest neighbours, inverted lists, projections, filters, validation."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.operators import filters, ivf, lsh, nearest as nn, search
from lectern.session import stage


def clustered(count, dim=8, centres=12, seed=5, hot=0.0):
    """Vectors around a few centres; a share ``hot`` of them is one and the same vector."""
    rnd = np.random.default_rng(seed)
    middle = rnd.normal(0, 10, (centres, dim))
    data = middle[rnd.integers(0, centres, count)] + rnd.normal(0, 0.5, (count, dim))
    data[: int(count * hot)] = middle[0]
    return data.astype(np.float32)


def tables(spark, data, asked):
    vectors = spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(data)], "vec_id long, embedding array<float>"
    ).repartition(4)
    queries = spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(asked)], "query_id long, query_vector array<float>"
    ).repartition(2)
    return vectors, queries


def brute(data, asked, k, allowed=None):
    found = {}
    for q, vector in enumerate(asked.astype(float)):
        distance = ((data.astype(float) - vector) ** 2).sum(axis=1)
        order = np.lexsort((np.arange(len(data)), distance))
        if allowed is not None:
            order = [i for i in order if i in allowed]
        found[q] = [int(i) for i in order[:k]]
    return found


def ranked(df):
    found = {}
    for row in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(row["query_id"], []).append(row["vec_id"])
        assert row["rank"] == len(found[row["query_id"]])
    return found


SMALL = dict(broadcast_bytes=1, cell_vectors=37, cell_queries=5)


@pytest.mark.parametrize("hot", [0.0, 0.4])
@pytest.mark.parametrize("k", [1, 7, 500])
def test_strategies_against_brute_force(spark, hot, k):
    data, asked = clustered(230, hot=hot), clustered(11, seed=6, hot=hot)
    vectors, queries = tables(spark, data, asked)
    expected = brute(data, asked, k)
    assert ranked(nn.nearest(vectors, queries, k)) == expected
    assert ranked(nn.nearest(vectors, queries, k, **SMALL)) == expected
    small = nn._small_side(vectors, "vec_id", "embedding", 1 << 20)
    assert ranked(nn._scan_queries(queries, small, k, nn._types(vectors, queries))) == expected


def test_empty_sides(spark):
    data = clustered(20)
    vectors, queries = tables(spark, data, data[:2])
    assert nn.nearest(vectors, queries.limit(0), 3).count() == 0
    assert nn.nearest(vectors.limit(0), queries, 3).count() == 0


def test_distance_and_zero_vector(spark):
    vectors, queries = tables(spark, np.array([[0.0, 0.0], [3.0, 4.0]], np.float32), np.zeros((1, 2), np.float32))
    rows = nn.nearest(vectors, queries, 2).orderBy("rank").collect()
    assert [r["distance"] for r in rows] == [0.0, 25.0]


@pytest.mark.parametrize("count, lists, probes", [(1, 1, 1), (39, 1, 1), (500, 12, 10), (2000, 51, 10)])
def test_ivf_parameters(spark, count, lists, probes):
    assert (ivf.list_count(count), ivf.probe_count(ivf.list_count(count))) == (lists, probes)
    row = ivf.parameters(spark.range(count).select(F.col("id").alias("vec_id"))).first()
    assert tuple(row) == (count, lists, probes)


@pytest.mark.parametrize("hot", [0.0, 0.4])
def test_ivf_of_all_lists_is_exact_and_cells_do_not_matter(spark, hot):
    data, asked = clustered(600, hot=hot), clustered(9, seed=7)
    vectors, queries = tables(spark, data, asked)
    centroids = stage(ivf.seed_centroids(vectors, 10), "centroids")
    lists = stage(ivf.build_lists(vectors, centroids), "lists")
    assert lists.count() == 600
    assert ranked(ivf.search(lists, centroids, queries, 5, nprobe=10)) == brute(data, asked, 5)
    few = ranked(ivf.search(lists, centroids, queries, 5, nprobe=2))
    assert ranked(ivf.search(lists, centroids, queries, 5, nprobe=2, cell_vectors=11, cell_queries=2)) == few


def test_trained_ivf_recall(spark):
    data, asked = clustered(2000), clustered(40, seed=8)
    vectors, queries = tables(spark, data, asked)
    centroids = stage(ivf.train_centroids(vectors, ivf.list_count(2000)), "centroids")
    found = ivf.search(stage(ivf.build_lists(vectors, centroids), "lists"), centroids, queries, 10)
    recall = search.recall(nn.nearest(vectors, queries, 10), found, 10)
    assert recall.agg(F.avg("recall")).first()[0] > 0.9


def test_lsh_recall_and_candidate_share(spark):
    data, asked = clustered(1500), clustered(30, seed=9)
    vectors, queries = tables(spark, data, asked)
    exact = nn.nearest(vectors, queries, 10)
    shape = lsh.Shape(8, lsh.bucket_width(vectors, 0.5), tables=8)
    placed = stage(lsh.with_lists(vectors, "embedding", shape), "placed")
    found = lsh.search(placed, queries, 10, shape)
    rows = found.collect()
    assert len(rows) == 300  # k for every query
    assert search.recall(exact, found, 10).agg(F.avg("recall")).first()[0] > 0.9
    left = lsh.by_list(placed).select("vec_id", "list_id")
    right = lsh.by_list(lsh.with_lists(queries, "query_vector", shape)).select("query_id", "list_id")
    candidates = left.join(right, "list_id").select("vec_id", "query_id").distinct().count()
    assert candidates / (1500 * 30) < 0.35


def test_lsh_with_a_crowded_bucket(spark):
    """A third of all vectors are equal; cell sizes do not change the result."""
    data, asked = clustered(400, hot=0.34), clustered(12, seed=5, hot=0.5)
    vectors, queries = tables(spark, data, asked)
    shape = lsh.Shape(8, lsh.bucket_width(vectors))
    placed = lsh.with_lists(vectors, "embedding", shape)
    whole = ranked(lsh.search(placed, queries, 10, shape))
    assert ranked(lsh.search(placed, queries, 10, shape, cell_vectors=13, cell_queries=3)) == whole
    assert whole[0] == list(range(10))


def test_filters(spark):
    df = spark.createDataFrame(
        [(1, "pdf", None), (2, "txt", 5), (3, None, 5)], "vec_id long, file_type string, size long"
    )

    def kept(wanted):
        return [r["vec_id"] for r in df.where(filters.matches(df, wanted)).orderBy("vec_id").collect()]

    assert kept(None) == kept({}) == [1, 2, 3]
    assert kept({"file_type": "pdf"}) == [1]
    assert kept({"file_type": ["pdf", "txt"], "size": 5}) == [2]
    assert kept({"file_type": []}) == kept({"doc_type": "pdf"}) == []
    assert kept({"size": None}) == [1]
    assert kept({"file_type": ["pdf", None]}) == [1, 3]
    assert kept({"size": "5"}) == kept({"size": ["x", 5.5]}) == kept({"file_type": 5}) == kept({"size": 1 << 70}) == []
    assert kept({"size": 5.0}) == kept({"size": ["x", 5]}) == [2, 3]
    assert kept({"size": float("nan")}) == kept({"vec_id": "1"}) == []
    assert kept({"vec_id": True}) == [1]


def test_a_task_sends_k_rows_per_query_whatever_its_batches(spark):
    data, asked = clustered(2000), clustered(6, seed=3)
    vectors, queries = tables(spark, data, asked)
    small = nn._small_side(queries, "query_id", "query_vector", 1 << 20)
    one_task = vectors.coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        found = nn._scan_vectors(one_task, small, 4, nn._types(vectors, queries))
        assert found.count() == 6 * 4
        assert ranked(nn.ranked(found, 4)) == brute(data, asked, 4)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_training_takes_every_vector(spark):
    data = clustered(900)
    vectors, _ = tables(spark, data, data[:1])
    centroids = ivf.train_centroids(vectors, 3, rounds=6).orderBy("list_id").collect()
    means = np.array([r["centroid"] for r in centroids])
    nearest_list = ((data[:, None, :].astype(float) - means[None]) ** 2).sum(-1).argmin(1)
    again = ivf.train_centroids(vectors.repartition(3), 3, rounds=7).orderBy("list_id").collect()
    moved = np.array([data[nearest_list == n].astype(float).mean(0) if (nearest_list == n).any() else means[n] for n in range(3)])
    assert np.allclose(moved, np.array([r["centroid"] for r in again]))


def test_filtered_search(spark):
    data, asked = clustered(300), clustered(6, seed=11)
    vectors, queries = tables(spark, data, asked)
    entries = vectors.withColumn("kind", F.when(F.col("vec_id") % 50 == 0, "rare").otherwise("common"))
    allowed = set(range(0, 300, 50))
    before = ranked(search.search_prefiltered(entries, queries, 4, {"kind": "rare"}))
    assert before == brute(data, asked, 4, allowed)
    after = ranked(search.search_postfiltered(entries, queries, 4, {"kind": "rare"}))
    near = brute(data, asked, 40)
    expected = {q: [i for i in ids if i in allowed][:4] for q, ids in near.items()}
    assert after == {q: ids for q, ids in expected.items() if ids}
    assert ranked(search.search_postfiltered(entries, queries, 4, None)) == brute(data, asked, 4)


def test_missing_metadata_keeps_nulls(spark):
    vectors, queries = tables(spark, clustered(20), clustered(1))
    found = search.with_metadata(nn.nearest(vectors, queries, 20), spark.range(5).selectExpr("id AS vec_id", "1 AS a"))
    assert sum(r["a"] is None for r in found.collect()) == 15


def test_validation(spark):
    vectors, _ = tables(spark, clustered(10), clustered(1))
    names = vectors.select("vec_id")
    assert search.validate(vectors, names, 8).first()["valid"]
    search.require_valid(vectors, names, 8)
    for broken, known, dim in (
        (vectors, names, 9),
        (vectors, names.limit(9), 8),
        (vectors.limit(9), names, 8),
        (vectors.withColumn("embedding", F.transform("embedding", lambda x: x * float("nan"))), names, 8),
        (vectors.withColumn("embedding", F.transform("embedding", lambda x: x + float("inf"))), names, 8),
        (vectors.unionByName(vectors), names.unionByName(names), 8),
    ):
        with pytest.raises(ValueError):
            search.require_valid(broken, known, dim)


def test_stats(spark):
    vectors, _ = tables(spark, clustered(10), clustered(1))
    assert tuple(search.stats(vectors, "Flat").first()) == (10, "Flat", 8)
