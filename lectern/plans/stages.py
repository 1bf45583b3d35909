"""The stages of a batch build. Each reads the table before it and writes its own, with metrics.

The metrics are counted by the jobs that write the tables, in their last stage, so that each task counts
once; nothing is read again for them.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from lectern.functions.text import content_hash, normalize_text
from lectern.operators import chunk, dedup, embed, metrics, parse, places
from lectern.operators.embed import HASHED, Encoders
from lectern.operators.rows import sized
from lectern.session import COMPACT, setting, stage, stage_parts
from lectern.sinks import tables as sink
from lectern.sources import files, tables


def documents_to_chunks(documents: DataFrame, key: str = "doc_id", carry: list[str] | None = None, **options) -> DataFrame:
    """Raw (key, text, ...) rows to chunks of the distinct normalised texts, in one plan."""
    clean = documents.withColumn("text", normalize_text("text")).withColumn("hash", content_hash("text"))
    kept = dedup.drop_duplicates(clean, key)
    return chunk.chunk_documents(kept.withColumnRenamed(key, "doc_id"), carry=carry, **options)


@dataclass(frozen=True)
class Corpus:
    """Where a corpus lives: the tables, and the side outputs beside them.

    Of a corpus kept in versions (see ``plans.snapshots``), documents, chunks and positions lie in the folder of
    the version; vectors, whose ids are those of their text, are shared by all versions.
    """

    root: str
    version: int | None = None

    def _at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def _of_version(self, name: str) -> str:
        return self._at(name if self.version is None else f"versions/{self.version:08}/{name}")

    @property
    def documents(self) -> str:
        return self._of_version("documents")

    @property
    def chunks(self) -> str:
        return self._of_version("chunks")

    @property
    def embeddings(self) -> str:
        return self._at("embeddings")

    @property
    def positions(self) -> str:
        return self._of_version("embedding_positions")

    @property
    def quarantine(self) -> str:
        return self._at("quarantine")

    def metrics(self, stage_name: str) -> str:
        return self._at(f"metrics/{stage_name}")

    @property
    def all_metrics(self) -> str:
        return self._at("metrics")


def _finish(corpus: Corpus, name: str, row: DataFrame) -> DataFrame:
    stored = metrics.stage_row(name, row)
    sink.write_json(stored, corpus.metrics(name))
    return row.sparkSession.read.schema(metrics.METRICS_SCHEMA).json(corpus.metrics(name))


def ingest(
    spark: SparkSession,
    input_path: str,
    corpus: Corpus,
    extractor: parse.Extractor | None = None,
    resume: bool = True,
    at: Column | None = None,
) -> DataFrame:
    """Files to the documents table; returns the metrics row.

    Every file is read and parsed once, folders of very many files one after the other: the parsed rows are staged, and failures, duplicates, counts
    and documents come from there. Text files and paged files are told apart by their names when the scans are
    planned, so that no file is opened by the branch that does not want it.
    """
    started = time.time()
    at = F.lit(int(started)).cast("timestamp") if at is None else at
    copies, seen = Observation(), {"parsed": 0, "failed": 0}
    ok = F.col("parse_success")

    def parsed() -> Iterator[DataFrame]:
        for part in files.parts(spark, input_path):
            counts = Observation()
            text_files, paged_files = files.scan_kinds(spark, part, files.TEXT_TYPES, files.PAGED_TYPES)
            rows = parse.parse_text(text_files).unionByName(parse.parse_paged(paged_files, extractor))
            yield parse.normalized(rows).observe(counts, F.count_if(ok).alias("parsed"), F.count_if(~ok).alias("failed"))
            for name, count in counts.get.items():  # once the part is written
                seen[name] += count

    with setting(spark, files.OPEN_COST, files.OPEN_COST_BYTES):
        ready = stage_parts(spark, parsed(), "parsed", COMPACT)
    documents = dedup.drop_duplicates(parse.to_documents(ready, at), "source_path", removed=copies)
    sink.write_documents(documents, corpus.documents, resume)
    sink.write_json(parse.failures(ready, at), corpus.quarantine)
    gone = copies.get["duplicates_removed"]
    counts = metrics.observed(
        spark, documents_processed=seen["parsed"] - gone, parse_failures=seen["failed"], duplicates_removed=gone
    )
    return _finish(corpus, "ingestion", metrics.ingest_row(counts, time.time() - started))


def chunk_corpus(spark: SparkSession, corpus: Corpus, strategy: str = "fixed", **options: int) -> DataFrame:
    """The documents table to the chunk table; returns the metrics row."""
    started = time.time()
    carry = ["source_path", "file_type", "ingestion_timestamp"]
    read, made = Observation(), Observation()
    documents = tables.load_documents(spark, corpus.documents).select("doc_id", "text", *carry)
    documents = documents.observe(read, F.count(F.lit(1)).alias("total_documents"))
    chunks = chunk.chunk_documents(documents, strategy, carry=carry, **options)
    sink.write_chunks(chunks.observe(made, *metrics.chunk_counts()), corpus.chunks)
    counts = metrics.observed(spark, **read.get, **made.get)
    return _finish(corpus, "chunking", metrics.chunk_row(counts, time.time() - started))


def embed_corpus(
    spark: SparkSession,
    corpus: Corpus,
    model_name: str = HASHED,
    encoders: Encoders | None = None,
    strategy: str | None = None,
    batch_size: int = embed.BATCH_SIZE,
    at: Column | None = None,
    commits: int = 1,
    keep_orphans: bool = False,
) -> DataFrame:
    """Vectors of the chunks the model has not embedded yet; returns the metrics row.

    Vectors of the model whose chunk is not stored any more, since documents were cut anew, are dropped, or
    stay, with ``keep_orphans``, for versions that still have their chunk.
    The table of positions, in the order of the chunk ids, is written anew.
    With ``commits``, the chunks are embedded in so many parts by a hash of their id, and each is stored
    when it is done: a run that is broken off keeps the finished parts, and the next one embeds the
    rest. Each part reads the chunk texts, so it is meant for encoders that cost far more than that.
    """
    started = time.time()
    encoders = encoders or Encoders()
    at = F.lit(int(started)).cast("timestamp") if at is None else at
    chunks = spark.read.parquet(corpus.chunks)
    if strategy:
        chunks = chunks.where(F.col("chunking_strategy") == strategy)
    chunks = chunks.select("chunk_id", "chunk_text")
    stored = tables.if_stored(lambda: spark.read.parquet(corpus.embeddings))
    if stored is not None:  # ids are compared, and the texts stay where they are
        todo = embed.not_yet_embedded(places.places(chunks, "chunk_id"), stored, model_name)
        chunks = places.picked(chunks, places.marks(todo))
    part = F.pmod(F.xxhash64("chunk_id"), F.lit(commits))
    for number in range(commits):
        mine = chunks.where(part == number) if commits > 1 else chunks
        embedded = encoders.embed(mine, model_name, batch_size=batch_size).select(
            "chunk_id", "embedding", "embedding_dim", at.alias("embedding_timestamp"), "model_name"
        )
        sink.write_embeddings(embedded, corpus.embeddings)
    if stored is not None and not keep_orphans:
        _drop_orphans(spark, corpus, model_name)
    vectors = spark.read.parquet(corpus.embeddings).where(F.col("model_name") == model_name)
    if stored is not None and keep_orphans:
        vectors = vectors.join(spark.read.parquet(corpus.chunks).select("chunk_id"), "chunk_id", "left_semi").select(*vectors.columns)
    placed = Observation()
    positions = embed.embedding_index(vectors, at).observe(placed, F.count(F.lit(1)).alias("total_embeddings"))
    sink.write_positions(positions, corpus.positions)
    counts = metrics.observed(spark, **placed.get)
    return _finish(corpus, "embedding", metrics.embed_row(counts, model_name, "cpu", time.time() - started))


def _drop_orphans(spark: SparkSession, corpus: Corpus, model_name: str) -> None:
    """Rewrite a model's vectors without those whose chunk is gone, if there are any. Runs after the new
    ones are stored, so that a run broken off before loses nothing."""
    stored = spark.read.parquet(corpus.embeddings).where(F.col("model_name") == model_name)
    known = spark.read.parquet(corpus.chunks).select("chunk_id")
    kept = places.marks(places.places(stored, "chunk_id").join(known, "chunk_id", "left_semi"))
    if places.marked_rows(kept) < stored.count():
        sink.replace_embeddings(places.picked(stored, kept), corpus.embeddings)


def apply_changes(
    spark: SparkSession, corpus: Corpus, incoming: DataFrame, strategy: str = "fixed", **options: int
) -> None:
    """Bring documents, chunks and vectors in line with an incoming documents table.

    Documents whose path is gone or whose text has changed leave, with their chunks and vectors; new and
    changed ones come in, with chunks by the given strategy and, where vectors are stored, vectors of the
    native encoder (other models are brought up to date by ``embed_corpus``). Documents that stay are
    neither cut nor embedded again. Doing it a second time changes nothing: only paths, hashes and ids are read
    then, and no text is written.
    """
    status = _status(tables.load_documents(spark, corpus.documents), incoming)
    if status.where("status <> 'same'").take(1) or not _chunks_belong(spark, corpus):
        with sink.replacing(spark, corpus.documents, corpus.chunks) as (documents, chunks):
            write_changed(spark, corpus, incoming, documents, chunks, strategy, status, **options)
    if tables.if_stored(lambda: spark.read.parquet(corpus.embeddings)) is not None:
        embed_corpus(spark, corpus)


def _status(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Staged (source_path, status) of a delivery."""
    return stage(dedup.changes(stored, incoming).select("source_path", "status"), "changes", COMPACT)


def _chunks_belong(spark: SparkSession, corpus: Corpus) -> bool:
    """Whether there are chunks, and each has its document; only ids are compared."""
    chunks = tables.if_stored(lambda: spark.read.parquet(corpus.chunks))
    known = tables.load_documents(spark, corpus.documents).select("doc_id")
    return chunks is not None and not chunks.select("doc_id").join(known, "doc_id", "left_anti").take(1)


def write_changed(
    spark: SparkSession,
    corpus: Corpus,
    incoming: DataFrame,
    documents_at: str,
    chunks_at: str,
    strategy: str = "fixed",
    status: DataFrame | None = None,
    **options: int,
) -> None:
    """Write documents and chunks of a corpus as they are after a delivery to folders that are not its own.

    What stays is picked from the stored tables where it lies. What comes in is written first, and cut from there.
    """
    stored = tables.load_documents(spark, corpus.documents)
    status = _status(stored, incoming) if status is None else status
    stays = status.where(F.col("status") == "same").select("source_path")
    kept = places.among(stored, stays, "source_path")
    comes = F.col("status").isin("new", "changed")
    by_path = status.where("source_path IS NOT NULL").groupBy("source_path").agg(F.bool_or(comes).alias("_comes"))
    by_path = stage(by_path, "delivered", COMPACT)
    fresh = places.split_off(incoming, "source_path", by_path.where("_comes"), by_path.where("NOT _comes"))
    fresh = dedup.not_yet_stored(dedup.drop_duplicates(fresh, "source_path"), sized(kept.select("hash")))
    common = [F.col(f.name).cast(f.dataType) for f in stored.unionByName(fresh.select(*stored.columns)).schema]
    sink.write_documents(fresh.select(*common), documents_at, resume=False)
    fresh = tables.load_documents(spark, documents_at)  # the files there now
    sink.append_documents(kept.select(*common), documents_at)
    chunks = tables.if_stored(lambda: spark.read.parquet(corpus.chunks))
    cut = chunk.chunk_documents(fresh, strategy, carry=["source_path", "file_type", "ingestion_timestamp"], **options)
    if chunks is not None:
        cut = places.among(chunks, kept.select("doc_id"), "doc_id").select(*cut.columns).unionByName(cut)
    sink.replace_chunks(cut, chunks_at)


def detect_changes(spark: SparkSession, corpus: Corpus, incoming: DataFrame) -> DataFrame:
    """(source_path, status) of an incoming documents table against the stored one."""
    return dedup.changes(tables.load_documents(spark, corpus.documents), incoming)
