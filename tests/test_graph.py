"""The neighbour graph: recall against exact search, the share of vectors looked at, small and odd tables."""

import os

import pytest
from pyspark.sql import functions as F

from lectern.operators import graph as op, nearest as nn, search
from lectern.session import stage
from tests.test_vectors import clustered, ranked, tables

SF = "/root/testdata/sf0.1/embeddings.parquet"


def check(vectors, queries, least, share, **options):
    exact = stage(nn.nearest(vectors, queries, 10), "exact")
    built = op.build_graph(vectors)
    found = stage(op.search(built, queries, 10, **options), "found")
    recall = search.recall(exact, found, 10).agg(F.avg("recall")).first()[0]
    looked = found.select("query_id", "looked_at").distinct().agg(F.avg("looked_at")).first()[0] / vectors.count()
    assert recall >= least and looked < share, (recall, looked)
    return built


def test_recall_and_share(spark):
    data, asked = clustered(700), clustered(20, seed=9)
    vectors, queries = tables(spark, data, asked)
    built = check(vectors, queries, 0.9, 0.5)
    degrees = built.edges.groupBy("vec_id").count()
    assert degrees.count() == 700 and degrees.where(F.col("count") > op.DEGREE).count() == 0
    assert built.edges.where("vec_id = neighbour").count() == 0


@pytest.mark.skipif(not os.path.exists(SF), reason="tables are not there")
def test_recall_on_the_given_vectors(spark):
    vectors = spark.read.parquet(SF).select("vec_id", "embedding")
    queries = vectors.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    check(vectors, queries, 0.9, 0.5)


def test_a_third_of_equal_vectors(spark):
    data, asked = clustered(300, hot=0.34), clustered(6, seed=5)
    vectors, queries = tables(spark, data, asked)
    found = op.search(op.build_graph(vectors, rounds=3), queries, 5)
    rows = found.collect()
    assert sorted({r["query_id"] for r in rows}) == list(range(6)) and len(rows) == 30
    assert all(r["looked_at"] <= 300 for r in rows)


def test_few_vectors_and_no_queries(spark):
    data, asked = clustered(7), clustered(3, seed=5)
    vectors, queries = tables(spark, data, asked)
    built = op.build_graph(vectors, rounds=2)
    assert ranked(op.search(built, queries, 10).drop("looked_at")) == ranked(nn.nearest(vectors, queries, 10))
    assert op.search(built, queries.where("false"), 3).count() == 0
    one = op.build_graph(vectors.where("vec_id = 0"), rounds=1)
    assert [r["vec_id"] for r in op.search(one, queries, 3).collect()] == [0, 0, 0]
    none = op.build_graph(vectors.where("false"), rounds=1)
    assert op.search(none, queries, 3).count() == 0


def test_a_call_compares_many_groups(spark):
    """a call for every group cost more than its distances. Groups stay apart, and copies of a member count once."""
    rows = [(c, m, [float(m), float(m * m % 7)]) for c, ms in {1: (1, 2, 3, 3, 9), 2: (2, 5, 8), 3: (4,)}.items() for m in ms]
    around = spark.createDataFrame(rows, "centre long, member long, embedding array<float>")
    vector = {m: v for _, m, v in rows}
    want = set()
    for group in ((1, 2, 3, 9), (2, 5, 8)):
        for m in group:
            others = sorted((sum((x - y) ** 2 for x, y in zip(vector[m], vector[o], strict=True)), o) for o in group if o != m)
            want |= {(m, o, d) for d, o in others[:2]}
    for buckets in (1, 3):
        got = op._local_joins(around, "bigint", 2, buckets).collect()
        assert {(r["vec_id"], r["neighbour"], r["distance"]) for r in got} == want and len(got) == len(want)
