"""A corpus kept in versions: what a delivery changes appears all at once, or not at all.

Every version has its own documents, chunks and positions below ``versions/v``. Vectors lie in one table for
all of them: their ids are derived from the text of their chunk, so a version needs no more than its
chunks to know its vectors. A version exists once its manifest is written, which is done last. A run that was
broken off leaves folders that no manifest names, and vectors of chunks that no version has; the
next attempt uses the vectors and overwrites the rest.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.operators.embed import HASHED
from lectern.plans import stages
from lectern.plans.stages import Corpus
from lectern.sinks import tables as sink
from lectern.sources import tables

_MANIFEST = "version int, parent int, model_name string, strategy string, documents long, chunks long, committed_at double"


def versions(spark: SparkSession, root: str) -> DataFrame:
    """One row per complete version."""
    reader = spark.read.schema(_MANIFEST).option("recursiveFileLookup", "true")
    stored = tables.if_stored(lambda: reader.json(f"{root.rstrip('/')}/manifest"))
    return spark.createDataFrame([], _MANIFEST) if stored is None else stored


def load_corpus(spark: SparkSession, root: str, version: int | None = None) -> Corpus:
    """The latest version of a corpus, or the one named; raises FileNotFoundError when there is none."""
    found = versions(spark, root)
    chosen = found if version is None else found.where(F.col("version") == version)
    row = chosen.orderBy(F.desc("version")).first()
    if row is None:
        raise FileNotFoundError(f"Corpus not found: {root}" + ("" if version is None else f", version {version}"))
    return Corpus(root, row["version"])


def vectors(spark: SparkSession, corpus: Corpus, model_name: str = HASHED) -> DataFrame:
    """The stored vectors of a version's chunks."""
    stored = spark.read.parquet(corpus.embeddings).where(F.col("model_name") == model_name)
    known = spark.read.parquet(corpus.chunks).select("chunk_id")
    return stored.join(known, "chunk_id", "left_semi").select(*stored.columns)


def deliver(
    spark: SparkSession,
    root: str,
    incoming: DataFrame,
    strategy: str = "fixed",
    model_name: str = HASHED,
    **options: int,
) -> Corpus:
    """Make a new version of an incoming documents table, the whole corpus as it is to be, and return it.

    Documents that stay are neither cut nor embedded again. Readers see the version before until the
    manifest is written. The first delivery makes version 0.
    """
    last = versions(spark, root).agg(F.max("version")).first()[0]
    target = Corpus(root, 0 if last is None else last + 1)
    if last is None:
        sink.write_documents(incoming, target.documents, resume=False)
        stages.chunk_corpus(spark, target, strategy, **options)
    else:
        stages.write_changed(spark, Corpus(root, last), incoming, target.documents, target.chunks, strategy, **options)
    stages.embed_corpus(spark, target, model_name, keep_orphans=True)
    counts = [spark.read.parquet(p).count() for p in (target.documents, target.chunks)]
    _commit(spark, target, (target.version, last, model_name, strategy, *counts, time.time()))
    return target


def _commit(spark: SparkSession, corpus: Corpus, row: tuple) -> None:
    sink.write_json(spark.createDataFrame([row], _MANIFEST), f"{corpus.root.rstrip('/')}/manifest/{corpus.version:08}")
