"""Ranked results to source lists, prompts and answers, one row per query.

``results`` has query_id, rank, chunk_id, chunk_text, doc_id, source_path, similarity_score. A query
has at most :data:`MAX_TOP_K` results, so the lists gathered per query are short by construction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Bounds of top_k, and the wording of prompts and answers.
MIN_TOP_K, DEFAULT_TOP_K, MAX_TOP_K = 1, 5, 20
UNKNOWN_SOURCE = "Unknown"
PROMPT = """You are a helpful assistant answering questions based on provided documents.

Context from relevant documents:
{context}

User Question: {query}

Instructions:
- Answer the question based on the provided context
- If the context doesn't contain enough information, say so
- Cite sources by referring to document numbers (e.g., "According to Document 1...")
- Be concise and accurate

Answer:"""
ANSWER_HEADER = "LLM not configured. Retrieved chunks:\n\n"
ANSWER_CHARS = 200
ERROR_HEADER = "Error generating answer: "
ERROR_MIDDLE = "\n\nRetrieved information:\n\n"
ERROR_CHARS, ERROR_CHUNKS = 300, 3
BETWEEN = "\n\n"


def check_top_k(k: int) -> int:
    if not MIN_TOP_K <= k <= MAX_TOP_K:
        raise ValueError(f"top_k must be between {MIN_TOP_K} and {MAX_TOP_K}")
    return k


def _per_query(results: DataFrame, *parts: Column) -> DataFrame:
    """(query_id, items): structs of a query's results in rank order."""
    item = F.struct(F.col("rank"), *parts)
    return results.groupBy("query_id").agg(F.sort_array(F.collect_list(item)).alias("items"))


def sources(results: DataFrame) -> DataFrame:
    """Flat source rows with empty strings for missing text and document."""
    return results.select(
        "query_id",
        "rank",
        "chunk_id",
        F.coalesce("chunk_text", F.lit("")).alias("chunk_text"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
        "source_path",
        "similarity_score",
    )


def source_list(results: DataFrame) -> DataFrame:
    """(query_id, sources, num_chunks_retrieved): the sources of a query as an array in rank order."""
    listed = _per_query(sources(results), *[F.col(field) for field in SOURCE_FIELDS])
    return listed.select(
        "query_id", F.col("items").alias("sources"), F.size("items").alias("num_chunks_retrieved")
    )


def _text() -> Column:
    return F.coalesce(F.col("chunk_text"), F.lit("")).alias("text")


def _named_source() -> Column:
    return F.coalesce(F.col("source_path"), F.lit(UNKNOWN_SOURCE)).alias("source")


def _filled_prompt() -> Column:
    """The prompt from ``items`` (with source and text) and ``query_text``."""
    blocks = F.transform(
        "items",
        lambda item: F.format_string(
            "[Document %d] (Source: %s)\n%s", item["rank"], item["source"], item["text"]
        ),
    )
    before, rest = PROMPT.split("{context}")
    between, after = rest.split("{query}")
    return F.concat(F.lit(before), F.array_join(blocks, BETWEEN), F.lit(between), "query_text", F.lit(after))


def format_prompt(results: DataFrame, queries: DataFrame) -> DataFrame:
    """(query_id, prompt): the numbered documents and the question in the prompt's template."""
    listed = _per_query(results, _named_source(), _text())
    return listed.join(queries, "query_id").select("query_id", _filled_prompt().alias("prompt"))


SOURCE_FIELDS = ["chunk_id", "chunk_text", "doc_id", "source_path", "similarity_score"]


def responses(results: DataFrame, queries: DataFrame) -> DataFrame:
    """(query_id, sources, num_chunks_retrieved, prompt, answer) from a single grouping of the results."""
    fields = [F.col(field) for field in SOURCE_FIELDS]
    listed = _per_query(sources(results), *fields, _named_source(), _text())
    kept = F.transform("items", lambda item: F.struct(*[item[f].alias(f) for f in ["rank", *SOURCE_FIELDS]]))
    return listed.join(queries, "query_id").select(
        "query_id",
        kept.alias("sources"),
        F.size("items").alias("num_chunks_retrieved"),
        _filled_prompt().alias("prompt"),
        F.concat(F.lit(ANSWER_HEADER), _excerpts(F.col("items"), ANSWER_CHARS)).alias("answer"),
    )


def _excerpts(items: Column, length: int) -> Column:
    lines = F.transform(
        items,
        lambda item: F.format_string("[%d] %s...", item["rank"], F.left(item["text"], F.lit(length))),
    )
    return F.array_join(lines, BETWEEN)


def extractive_answer(results: DataFrame) -> DataFrame:
    """(query_id, answer): the answer without a generator, the beginnings of all results."""
    return _per_query(results, _text()).select(
        "query_id", F.concat(F.lit(ANSWER_HEADER), _excerpts(F.col("items"), ANSWER_CHARS)).alias("answer")
    )


def error_answer(results: DataFrame, error: Column) -> DataFrame:
    """(query_id, answer): the answer after a failed generator, the beginnings of the first three."""
    first = F.filter("items", lambda item: item["rank"] <= ERROR_CHUNKS)
    return _per_query(results, _text()).select(
        "query_id",
        F.concat(
            F.lit(ERROR_HEADER), error, F.lit(ERROR_MIDDLE), _excerpts(first, ERROR_CHARS)
        ).alias("answer"),
    )
