"""Stored tables and side outputs.

Side outputs go to folders next to a table, never into it, so that the table stays readable.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from lectern.operators.dedup import not_yet_stored
from lectern.operators.ordering import BATCH_ROWS
from lectern.session import COMPACT
from lectern.sources.tables import if_stored


def write_documents(documents: DataFrame, path: str, resume: bool = True, file_rows: int = BATCH_ROWS) -> None:
    """Append the documents whose hash is not stored yet, or replace the table.

    One write job: a lost task is run again by Spark, an aborted job leaves nothing, and a rerun adds
    only what is missing. Files hold at most ``file_rows`` rows.
    """
    spark = documents.sparkSession
    mode = "overwrite"
    stored = if_stored(lambda: spark.read.parquet(path)) if resume else None
    if stored is not None:
        documents = not_yet_stored(documents, stored)
        mode = "append"
    documents.write.options(**COMPACT).option("maxRecordsPerFile", file_rows).mode(mode).parquet(path)


def append_documents(documents: DataFrame, path: str, file_rows: int = BATCH_ROWS) -> None:
    """Append documents to a table, whatever it holds."""
    documents.write.options(**COMPACT).option("maxRecordsPerFile", file_rows).mode("append").parquet(path)


def write_chunks(chunks: DataFrame, path: str) -> None:
    """Replace the chunks of the strategies at hand; other strategies' partitions stay."""
    chunks.write.options(**COMPACT).option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(
        "chunking_strategy"
    ).parquet(path)


def replace_chunks(chunks: DataFrame, path: str) -> None:
    """Replace the whole chunk table, from rows that are not read from the same path."""
    static = chunks.write.options(**COMPACT).option("partitionOverwriteMode", "static")
    static.mode("overwrite").partitionBy("chunking_strategy").parquet(path)


def write_embeddings(embedded: DataFrame, path: str) -> None:
    """Append vectors, a partition per model."""
    embedded.write.options(**COMPACT).mode("append").partitionBy("model_name").parquet(path)


def replace_embeddings(embedded: DataFrame, path: str) -> None:
    """Replace the vectors of the models at hand; they may be read from the same path."""
    spark, new = embedded.sparkSession, _beside(path)
    write_embeddings(embedded, new)
    for folder in _subfolders(spark, new):
        _swap(spark, f"{new}/{folder}", f"{path}/{folder}")
    _delete(spark, new)


def write_positions(positions: DataFrame, path: str) -> None:
    """Replace the table of embedding positions of the models at hand."""
    positions.write.options(**COMPACT).option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("model_name").parquet(path)


@contextmanager
def replacing(spark: SparkSession, *paths: str) -> Iterator[list[str]]:
    """Folders beside the tables, to write them anew while the old ones are still read. Once all are written, the
    folders take the places of the tables; a run that is broken off before leaves the tables as they were."""
    new = [_beside(path) for path in paths]
    yield new
    for written, path in zip(new, paths, strict=True):
        _swap(spark, written, path)


def _beside(path: str) -> str:
    return f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"


def _store(spark: SparkSession, path: str):
    """Hadoop's view of the store that a path lies in, and of the path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def _subfolders(spark: SparkSession, path: str) -> list[str]:
    store, at = _store(spark, path)
    return [f.getPath().getName() for f in store.listStatus(at) if f.isDirectory() and "=" in f.getPath().getName()]


def _swap(spark: SparkSession, new: str, path: str) -> None:
    """Rename a folder to a table's name; the one before is deleted afterwards."""
    store, target = _store(spark, path)
    _, old = _store(spark, f"{path.rstrip('/')}.old-{uuid.uuid4().hex}")
    there = store.exists(target)
    if there and not store.rename(target, old):
        raise OSError(f"{path} cannot be replaced")
    if not store.rename(_store(spark, new)[1], target):
        if there:
            store.rename(old, target)
        raise OSError(f"{new} cannot be renamed to {path}")
    if there:
        store.delete(old, True)


def _delete(spark: SparkSession, path: str) -> None:
    store, at = _store(spark, path)
    store.delete(at, True)


def write_json(rows: DataFrame, path: str) -> None:
    """Side output: metrics or quarantine rows."""
    rows.write.mode("overwrite").json(path)


def write_csv(row: DataFrame, path: str) -> None:
    """Side output: the exported metrics row with its header."""
    row.coalesce(1).write.mode("overwrite").option("header", "true").csv(path)  # one row
