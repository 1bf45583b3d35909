"""Batch retrieval: a table of queries in, ranked sources, prompts and answers out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from lectern.operators import prompt
from lectern.operators.embed import Encoders
from lectern.operators.requests import checked, rejected
from lectern.plans.indexing import Index
from lectern.session import stage


def embed_queries(queries: DataFrame, model_name: str, encoders: Encoders | None = None) -> DataFrame:
    """Staged (query_id, query_vector), by the encoder the index was built with: encoded only once."""
    embedded = (encoders or Encoders()).embed(queries, model_name, text="query_text")
    return stage(embedded.select("query_id", F.col("embedding").alias("query_vector")), "asked")


def retrieve(
    index: Index,
    queries: DataFrame,
    k: int = prompt.DEFAULT_TOP_K,
    filters: Mapping[str, object] | None = None,
    encoders: Encoders | None = None,
    postfilter: bool = False,
) -> DataFrame:
    """Ranked results of all (query_id, query_text) rows; k is bounded as for a single request."""
    asked = embed_queries(queries, index.model_name, encoders)
    found = index.search(asked, prompt.check_top_k(k), filters, postfilter)
    return found.withColumnRenamed("vec_id", "chunk_id")


def retrieve_requests(
    index: Index, requests: DataFrame, encoders: Encoders | None = None
) -> tuple[DataFrame, DataFrame]:
    """(results, rejected) of (query_id, query_text, top_k, filters) rows.

    Every request has its own number of results, 1 to 20 and by default 5, and its own filters, a JSON object
    or null. Requests out of range are rejected with a reason; the others are answered by one search.
    """
    given = requests.select(*[c for c in requests.columns if c in ("query_id", "query_text", "top_k", "filters")])
    good = checked(given).where("error IS NULL").select("query_id", "query_text")
    asked = embed_queries(good, index.model_name, encoders)
    found = index.answer(asked.join(given.drop("query_text"), "query_id"))
    return found.withColumnRenamed("vec_id", "chunk_id"), rejected(given)


def outcome(
    results: DataFrame, queries: DataFrame, retrieval_seconds: float = 0.0, generation_seconds: float = 0.0
) -> DataFrame:
    """One row per query, also for those without results: num_chunks_retrieved, found, and times in ms.

    A batch is answered as a whole, so its times are those of every query in it.
    """
    counts = results.groupBy("query_id").agg(F.count("*").alias("_found"))
    retrieved = F.coalesce("_found", F.lit(0))
    times = {
        "retrieval_ms": retrieval_seconds,
        "generation_ms": generation_seconds,
        "total_ms": retrieval_seconds + generation_seconds,
    }
    return queries.select("query_id").join(counts, "query_id", "left").select(
        "query_id",
        retrieved.alias("num_chunks_retrieved"),
        (retrieved > 0).alias("found"),
        *[F.lit(round(seconds * 1000.0, 2)).alias(name) for name, seconds in times.items()],
    )


def respond(results: DataFrame, queries: DataFrame) -> DataFrame:
    """(query_id, sources, num_chunks_retrieved, prompt, answer) of every query with results."""
    return prompt.responses(results, queries)
