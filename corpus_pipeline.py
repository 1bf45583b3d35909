"""Corpus pipeline: the documents through five operators, one stage after the other.

Every stage takes the session, the rows that its predecessor kept and the folder of the tables, and
returns a DataFrame, which is written as Parquet and read again as the next one's documents. All but
the last return the columns of the documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lectern.llm import exact_dedup, mixing, near_copies, packing, toxicity
from lectern.llm.queries import VOCABULARY
from lectern.session import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not flag. It learns from the labels of this folder."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the largest id."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates (five-word shingles, at 0.8): the smallest id."""
    return near_copies.one_per_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, written in the order of the mix."""
    return mixing.in_mix_order(docs)


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences with their bucket, batch and place, batched in the order in which they are stored."""
    return packing.pack_tokens(docs, public_tokenizers.path(VOCABULARY), order=packing.written_order())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("packing", pack_batches),
]

# Neither a trained classifier nor connected components of XXH64 fingerprints are expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what each returns is stored before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
