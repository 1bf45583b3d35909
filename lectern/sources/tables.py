"""Parquet tables of the corpus."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from lectern.operators.metrics import METRICS_SCHEMA


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores when the scan has fewer partitions than there are cores.

    A table of one file and one row group would otherwise be worked on by a single task. A scan of
    many files has far more partitions than cores and is left alone, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A stored table, only the named columns of it."""
    table = spark.read.parquet(path)
    return spread(table.select(*columns) if columns else table)


def load_documents(spark: SparkSession, path: str) -> DataFrame:
    """The documents table; a missing path raises Spark's own error."""
    return spark.read.parquet(path)


def load_embed_input(spark: SparkSession, path: str) -> DataFrame:
    """What an encoder needs of the chunk table: ids and texts, nothing else is read from disk."""
    return spark.read.parquet(path).select("chunk_id", "chunk_text")


INDEX_METADATA = ["chunk_text", "doc_id", "source_path", "file_type", "chunk_index", "token_count"]


def load_index_metadata(spark: SparkSession, path: str) -> DataFrame:
    """What search results carry of the chunk table."""
    return spark.read.parquet(path).select("chunk_id", *INDEX_METADATA)


def if_stored(read: Callable[[], DataFrame]) -> DataFrame | None:
    """The table, or None when nothing has been written at its path yet."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def load_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Stored metrics rows of all stages; a folder that is not there gives no rows."""
    reader = spark.read.schema(METRICS_SCHEMA).option("recursiveFileLookup", "true")
    stored = if_stored(lambda: reader.json(path))
    return spark.createDataFrame([], METRICS_SCHEMA) if stored is None else stored
