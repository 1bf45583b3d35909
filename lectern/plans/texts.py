"""TF-IDF retrieval straight from a folder of files: scan, decode, chunk, fit, query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.operators import chunk, parse, tfidf
from lectern.operators.rows import sized
from lectern.session import stage
from lectern.sources import files

KEYS = ["source", "chunk_id"]


def load_units(spark: SparkSession, path: str, extractor: parse.Extractor | None = None) -> DataFrame:
    """(source, content, chunk_id, total_chunks): sentence chunks of the text and paged files in a folder.

    Unreadable files stay as a placeholder text, blank ones are skipped. The text is taken as it is,
    without normalisation. The chunks are stored, so that each file is opened and parsed once.
    """
    parsed = parse.parse_text(files.scan_flat(spark, path, ["txt"])).unionByName(
        parse.parse_paged(files.scan_flat(spark, path, files.PAGED_TYPES), extractor)
    )
    named = parse.with_placeholder(parsed).select(F.regexp_extract("source_path", "([^/]*)$", 1).alias("source"), "text")
    chunks = chunk.sentence_windows(named, carry=["source"]).select(
        "source",
        F.col("chunk_text").alias("content"),
        F.col("chunk_index").alias("chunk_id"),
        "total_chunks",
    )
    return stage(chunks, "text-units")


def ask(units: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, similarity, source, chunk_id, total_chunks, content) of the best chunks.

    The few results are staged and, within the bound, sent to the chunks to fetch their texts.
    """
    found = stage(tfidf.search(units, queries, KEYS, k, "content"), "found")
    return units.join(sized(found), KEYS).select(
        "query_id", "rank", "similarity", *KEYS, "total_chunks", "content"
    )
