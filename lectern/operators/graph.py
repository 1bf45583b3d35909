"""Approximate nearest neighbours by a graph: an edge table from every vector to some of its nearest.

The graph starts from random edges and is refined in rounds: the neighbours of a vector are likely to be
neighbours of each other, so every vector compares its own with each other and offers each of them the
others. A search walks the graph from a few entry vectors, and keeps a bounded beam of the nearest
found per query. Edges, beams and vectors are tables; no machine holds the graph.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from lectern.operators.nearest import nearest, ranked
from lectern.operators.rows import sized, top_k
from lectern.session import stage

# Edges per vector, rounds of refinement, entry vectors of a search per square root of all, and beam width.
DEGREE = 16
ROUNDS = 5
ENTRIES_PER_SQRT = 1
BEAM = 24
STEPS = 8

# Vectors whose groups of neighbours are compared in one call of a worker.
BUCKET_CENTRES = 256


@dataclass(frozen=True)
class Graph:
    """``edges`` (vec_id, neighbour, distance) and ``vectors`` (vec_id, embedding), both stored."""

    vectors: DataFrame
    edges: DataFrame
    degree: int


def _random_edges(vectors: DataFrame, degree: int) -> DataFrame:
    """(vec_id, neighbour): vectors that are next to each other in two random orders. The orders are cut into
    runs of bounded length, so that no task orders all."""
    runs = max(1, math.ceil(vectors.count() / (64 * degree)))
    edges = None
    for seed in range(2):
        order = F.xxhash64("vec_id", F.lit(seed))
        listed = vectors.groupBy(F.pmod(order, F.lit(runs)).alias("_run")).agg(F.sort_array(F.collect_list(F.struct(order.alias("at"), "vec_id"))).alias("_all"))
        pairs = listed.select(F.posexplode("_all").alias("_i", "_one"), "_all").select(
            F.col("_one.vec_id").alias("vec_id"),
            F.explode(F.slice("_all", F.col("_i") + 2, F.lit(max(1, degree // 4)))).alias("_next"),
        )
        part = pairs.select("vec_id", F.col("_next.vec_id").alias("neighbour"))
        edges = part if edges is None else edges.unionByName(part)
    return edges


def _local_joins(around: DataFrame, kind: str, degree: int, buckets: int) -> DataFrame:
    """(vec_id, neighbour, distance): in every vector's group of neighbours, each one's nearest of the others. The
    groups are dealt to buckets, and a call compares those of one bucket, one after the other."""

    def join(table):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        vectors = table.column("embedding").combine_chunks()
        if pc.count_distinct(pc.list_value_length(vectors), mode="all").as_py() != 1 or vectors.null_count:
            raise ValueError("the vectors are not all of one length")
        matrix = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)
        centres = table.column("centre").combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
        members = table.column("member").combine_chunks().dictionary_encode()
        ids, member = members.dictionary, members.indices.to_numpy()
        order = np.lexsort((member, centres))
        same = (np.diff(centres[order]) == 0) & (np.diff(member[order]) == 0)
        order = order[np.r_[True, ~same]]
        cuts = np.r_[0, np.flatnonzero(np.diff(centres[order])) + 1, len(order)].tolist()
        left, right, distance = [order[:0]], [order[:0]], [np.zeros(0)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            count = min(degree, b - a - 1)
            if count < 1:
                continue
            own, block = member[order[a:b]], matrix[order[a:b]].astype(np.float64)
            lengths = np.einsum("ij,ij->i", block, block)
            square = np.maximum(lengths[:, None] + lengths[None, :] - 2.0 * block @ block.T, 0.0)
            np.fill_diagonal(square, np.inf)
            near = np.argpartition(square, count - 1, axis=1)[:, :count]
            left.append(np.repeat(own, count))
            right.append(own[near.reshape(-1)])
            distance.append(np.take_along_axis(square, near, axis=1).reshape(-1))
        ends = [ids.take(pa.array(np.concatenate(side))) for side in (left, right)]
        return pa.table([*ends, pa.array(np.concatenate(distance))], names=["vec_id", "neighbour", "distance"])

    dealt = around.withColumn("_bucket", F.pmod(F.xxhash64("centre"), F.lit(buckets)))
    return dealt.groupBy("_bucket").applyInArrow(join, f"vec_id {kind}, neighbour {kind}, distance double")


def build_graph(vectors: DataFrame, degree: int = DEGREE, rounds: int = ROUNDS) -> Graph:
    """The graph of (vec_id, embedding) rows with unique ids.

    In a round a vector's group holds itself, those it has edges to and as many of those that have edges to it,
    chosen by a hash, so groups are bounded however many vectors are near to one. A group sends each
    member its nearest others; the ``degree`` nearest of all that a vector is sent are its new edges.
    """
    vectors = stage(vectors.select("vec_id", "embedding"), "graph-vectors")
    kind = vectors.schema["vec_id"].dataType.simpleString()
    pairs = stage(_random_edges(vectors, degree).where("vec_id <> neighbour").distinct(), "graph-random")
    edges = pairs.withColumn("distance", F.lit(float("inf")))
    buckets = max(1, math.ceil(vectors.count() / BUCKET_CENTRES))
    for _ in range(rounds):
        out = edges.select(F.col("vec_id").alias("centre"), F.col("neighbour").alias("member"))
        back = edges.select(F.col("neighbour").alias("centre"), F.col("vec_id").alias("member"))
        back = top_k(back, "centre", [F.xxhash64("centre", "member")], degree).drop("rank")
        own = vectors.select(F.col("vec_id").alias("centre"), F.col("vec_id").alias("member"))
        members = out.unionByName(back).unionByName(own)
        around = members.join(vectors.withColumnRenamed("vec_id", "member"), "member")
        offered = _local_joins(around, kind, degree, buckets)
        known = edges.where(F.col("distance") < float("inf"))
        best = offered.unionByName(known.select("vec_id", "neighbour", "distance"))
        best = best.groupBy("vec_id", "neighbour").agg(F.min("distance").alias("distance"))
        edges = top_k(best, "vec_id", [F.col("distance"), F.col("neighbour")], degree).drop("rank")
        edges = stage(edges, "graph-edges")
    return Graph(vectors, edges, degree)


def search(graph: Graph, queries: DataFrame, k: int, beam: int = BEAM, steps: int = STEPS) -> DataFrame:
    """(query_id, vec_id, distance, rank, looked_at): approximately the k nearest vectors.

    The beam starts with the nearest of about a square root of all vectors, chosen by a hash. In a step, the
    neighbours, in both directions, of what is new in a query's beam are looked at, once per query, and the
    ``beam`` nearest of all stay; a query is done when nothing new is among them. ``looked_at`` counts
    the vectors whose distance was computed. Fewer than k vectors give all that can be reached.
    """
    beam = max(beam, k)
    vectors, total = graph.vectors, graph.vectors.count()
    asked = stage(queries.select("query_id", "query_vector"), "graph-asked")
    some = vectors.orderBy(F.xxhash64("vec_id")).limit(max(beam, math.ceil(ENTRIES_PER_SQRT * math.sqrt(total))))
    some = stage(some, "graph-entries")
    both = graph.edges.select("vec_id", "neighbour").unionByName(
        top_k(graph.edges.select(F.col("neighbour").alias("vec_id"), F.col("vec_id").alias("neighbour"), "distance"), "vec_id", [F.col("distance"), F.col("neighbour")], graph.degree).select("vec_id", "neighbour")
    )
    both = stage(both.distinct(), "graph-both")
    best = stage(nearest(some, asked, beam).select("query_id", "vec_id", "distance"), "graph-beam")
    entries, met = some.count(), best.select("query_id", "vec_id")
    fresh = best.select("query_id", "vec_id")
    for _ in range(steps):
        ahead = both.join(sized(fresh), "vec_id").select("query_id", F.col("neighbour").alias("vec_id")).distinct()
        ahead = stage(ahead.join(met, ["query_id", "vec_id"], "left_anti"), "graph-ahead")
        if not ahead.take(1):
            break
        met = met.unionByName(ahead)
        scored = _distances(vectors.join(sized(ahead), "vec_id").join(sized(asked), "query_id"), asked, vectors)
        marked = best.withColumn("_new", F.lit(False)).unionByName(scored.withColumn("_new", F.lit(True)))
        marked = stage(ranked(marked, beam), "graph-beam")
        best = marked.select("query_id", "vec_id", "distance")
        fresh = marked.where("_new").select("query_id", "vec_id")
    counts = met.groupBy("query_id").agg((F.count("*") - beam + entries).alias("looked_at"))
    return ranked(best, k).join(counts, "query_id").select("query_id", "vec_id", "distance", "rank", "looked_at")


def _distances(rows: DataFrame, asked: DataFrame, vectors: DataFrame) -> DataFrame:
    """(query_id, vec_id, distance) of rows that hold both vectors."""
    kinds = [f"query_id {asked.schema['query_id'].dataType.simpleString()}", f"vec_id {vectors.schema['vec_id'].dataType.simpleString()}"]

    def run(batches: Iterator) -> Iterator:
        import numpy as np

        for batch in batches:
            if not batch.empty:
                gap = np.stack(batch["embedding"].to_numpy()).astype(np.float64) - np.stack(batch["query_vector"].to_numpy()).astype(np.float64)
                yield batch[["query_id", "vec_id"]].assign(distance=np.einsum("ij,ij->i", gap, gap))

    return rows.select("query_id", "vec_id", "embedding", "query_vector").mapInPandas(run, ", ".join([*kinds, "distance double"]))
