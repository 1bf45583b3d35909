"""Exact duplicates and resumable loads, both by content hash."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from lectern.operators.rows import BROADCAST_ROWS, fits
from lectern.session import stage


def survivors(df: DataFrame, key: str, text_hash: str = "hash") -> DataFrame:
    """Smallest key of every hash with the number of its copies.

    Only the two narrow columns are read and shuffled, and each task sends one row per hash, however
    many copies it holds.
    """
    return df.groupBy(text_hash).agg(F.min(key).alias(key), F.count("*").alias("copies"))


def drop_duplicates(
    df: DataFrame,
    key: str,
    text_hash: str = "hash",
    broadcast_rows: int = BROADCAST_ROWS,
    removed: Observation | None = None,
) -> DataFrame:
    """Keep the row with the smallest key of every hash. ``key`` is unique per row, no hash is null.

    Where few texts have copies, those are broadcast and the other columns are not shuffled at all.
    Otherwise the rows join the survivors on their unique key. Either way the copies of a text are
    never gathered in one task. ``removed`` takes up the number of rows that go, as ``duplicates_removed``.
    """
    several = survivors(df, key, text_hash).where("copies > 1")
    if removed is not None:
        several = several.observe(removed, F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates_removed"))
    copied = stage(several, "copied")
    if fits(copied, broadcast_rows):
        first = F.broadcast(copied.select(text_hash, F.col(key).alias("_first")))
        marked = df.join(first, text_hash, "left")
        kept = marked.where(F.col("_first").isNull() | (F.col("_first") == F.col(key)))
    else:
        kept = df.join(survivors(df, key, text_hash).select(key), key, "left_semi")
    return kept.select(*df.columns)


def duplicate_stats(df: DataFrame, text_hash: str = "hash") -> DataFrame:
    """One row: rows read, distinct texts, duplicates removed."""
    per_hash = df.groupBy(text_hash).agg(F.count("*").alias("copies"))
    return per_hash.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("documents_read"),
        F.count("*").alias("documents_kept"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates_removed"),
    )


def not_yet_stored(incoming: DataFrame, stored: DataFrame, keys: str | list[str] = "hash") -> DataFrame:
    """Incoming rows whose keys the stored table lacks; only the key columns of it are read."""
    keys = [keys] if isinstance(keys, str) else keys
    return incoming.join(stored.select(*keys), keys, "left_anti").select(*incoming.columns)


def changes(stored: DataFrame, incoming: DataFrame, key: str = "source_path", text_hash: str = "hash") -> DataFrame:
    """Per key: ``new``, ``changed``, ``deleted`` or ``same``."""
    old = stored.select(key, F.col(text_hash).alias("stored_hash"))
    new = incoming.select(key, F.col(text_hash).alias("incoming_hash"))
    status = (
        F.when(F.col("stored_hash").isNull(), "new")
        .when(F.col("incoming_hash").isNull(), "deleted")
        .when(F.col("stored_hash") != F.col("incoming_hash"), "changed")
        .otherwise("same")
    )
    return old.join(new, key, "full").select(key, "stored_hash", "incoming_hash", status.alias("status"))
