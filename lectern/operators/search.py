"""Search results: metadata, filters, validation, statistics and recall of a vector index."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from lectern.operators.filters import matches
from lectern.operators.nearest import nearest
from lectern.operators.rows import sized, top_k
from lectern.session import stage

# Fixed value: how many times k is fetched when filters are applied after the search.
OVERFETCH = 10


def with_metadata(found: DataFrame, metadata: DataFrame) -> DataFrame:
    """Result rows with the metadata of their vector; a vector without metadata keeps nulls.

    The results are staged, so their size is known: when it is within the bound their ids are sent to
    the scan of the metadata, and the texts of a large corpus are never shuffled for a few results.
    """
    found = stage(found, "found")
    ids = found.select("vec_id").distinct()
    needed = metadata.join(sized(ids), "vec_id", "left_semi")
    return found.join(needed, "vec_id", "left")


def metadata_of(entries: DataFrame) -> DataFrame:
    """The entries without what only a search needs."""
    return entries.drop("embedding", "list_id", "list_ids")


def search_prefiltered(
    entries: DataFrame, queries: DataFrame, k: int, filters: Mapping[str, object] | None
) -> DataFrame:
    """Exact filtered search: the k nearest among the entries whose metadata match.

    ``entries`` holds vec_id, embedding and the metadata columns, so the filter is a scan predicate.
    """
    kept = entries.where(matches(entries, filters)).select("vec_id", "embedding")
    return with_metadata(nearest(kept, queries, k), metadata_of(entries))


def search_postfiltered(
    entries: DataFrame,
    queries: DataFrame,
    k: int,
    filters: Mapping[str, object] | None,
    candidates: Callable[[DataFrame, int], DataFrame] | None = None,
) -> DataFrame:
    """Filter after the search: among the 10 k nearest, those that match, at most k.

    May give fewer than k rows where :func:`search_prefiltered` finds k. ``candidates`` replaces the
    exact search behind it.
    """
    find = candidates or (lambda asked, n: nearest(entries.select("vec_id", "embedding"), asked, n))
    if not filters:
        return with_metadata(find(queries, k), metadata_of(entries))
    fetched = with_metadata(find(queries, k * OVERFETCH).drop("rank"), metadata_of(entries))
    matching = fetched.where(matches(fetched, filters))
    return top_k(matching, "query_id", [F.col("distance"), F.col("vec_id")], k)


def with_similarity(found: DataFrame) -> DataFrame:
    """Results with ``similarity_score``, which is the distance: lower is better."""
    return found.withColumn("similarity_score", F.col("distance"))


def validate(vectors: DataFrame, metadata: DataFrame, dim: int) -> DataFrame:
    """One row: counts of vectors, of ids and of every defect, and whether the index is valid.

    The ids of both sides are shuffled once, to be counted per id.
    """
    broken = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sides = vectors.select("vec_id", F.lit(1).alias("_v"), F.lit(0).alias("_m")).union(
        metadata.select("vec_id", F.lit(0).alias("_v"), F.lit(1).alias("_m"))
    )
    each = sides.groupBy("vec_id").agg(F.sum("_v").alias("_v"), F.sum("_m").alias("_m"))
    known, total = F.col("vec_id").isNotNull(), lambda c: F.coalesce(F.sum(c), F.lit(0))  # a null id matches nothing
    by_id = each.agg(
        (total("_v") - F.count_if(known & (F.col("_v") > 0))).alias("repeated_vectors"),
        total("_m").alias("total_ids"),
        (total("_m") - F.count_if(known & (F.col("_m") > 0))).alias("repeated_ids"),
        total(F.when(~known | (F.col("_m") == 0), F.col("_v"))).alias("without_metadata"),
        total(F.when(~known | (F.col("_v") == 0), F.col("_m"))).alias("without_vector"),
    )
    counts = vectors.agg(
        F.count("*").alias("total_vectors"),
        F.count_if(F.size("embedding") != dim).alias("wrong_dimension"),
        F.count_if(F.col("embedding").isNull() | broken).alias("not_finite"),
    ).crossJoin(by_id)  # one row each
    sound = F.col("total_vectors") == F.col("total_ids")
    for defect in ("wrong_dimension", "not_finite", "without_vector", "repeated_vectors", "repeated_ids"):
        sound = sound & (F.col(defect) == 0)
    return counts.withColumn("valid", sound)


def require_valid(vectors: DataFrame, metadata: DataFrame, dim: int) -> None:
    """Fail the job if the index is not valid, or if a search for one of its vectors does not find it."""
    report = validate(vectors, metadata, dim).first()
    if not report["valid"]:
        raise ValueError(f"invalid index: {report.asDict()}")
    probe = vectors.orderBy(F.md5(F.col("vec_id").cast("string"))).limit(1)
    asked = probe.select(F.lit(0).alias("query_id"), F.col("embedding").alias("query_vector"))
    if [row["distance"] for row in nearest(vectors.select("vec_id", "embedding"), asked, 1).collect()] != [0.0]:
        raise ValueError("invalid index: a search for a stored vector does not find it")


def stats(vectors: DataFrame, index_type: str | Column) -> DataFrame:
    """One row: total_vectors, index_type, embedding_dim."""
    kind = F.lit(index_type) if isinstance(index_type, str) else index_type
    return vectors.agg(
        F.count("*").alias("total_vectors"),
        F.max(F.size("embedding")).alias("embedding_dim"),
    ).select("total_vectors", kind.alias("index_type"), "embedding_dim")


def recall(exact: DataFrame, approximate: DataFrame, k: int) -> DataFrame:
    """(query_id, recall): share of the exact top k that the approximate top k holds."""
    hit = approximate.select("query_id", "vec_id", F.lit(1).alias("_hit"))
    return (
        exact.join(hit, ["query_id", "vec_id"], "left")
        .groupBy("query_id")
        .agg((F.count("_hit") / F.lit(k)).alias("recall"))
    )
