"""Exact duplicates by progressive refinement: length, then a hash of the first characters, then the
hash of the whole text, which is taken only where the two cheaper keys have met a second time.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lectern.llm.common import ascii_lower
from lectern.operators.rows import BROADCAST_ROWS, sized
from lectern.session import stage

# Characters under the second key. Any number is right; more tell more texts apart before the full hash.
PREFIX_CHARS = 256

KEYS = ["__length", "__prefix"]


def content_hash(text: Column) -> Column:
    """SHA-256 of the text with A-Z in lower case; null counts as empty."""
    return F.sha2(ascii_lower(text), 256)


def _keyed(docs: DataFrame, text: str, prefix_chars: int) -> DataFrame:
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumn("__text", whole).withColumns(
        {
            "__length": F.octet_length("__text"),
            "__prefix": F.xxhash64(ascii_lower(F.substring("__text", 1, prefix_chars))),
        }
    )


def _shared_keys(docs: DataFrame, id_col: str, text: str, prefix_chars: int) -> tuple[DataFrame, DataFrame]:
    """Per (length, prefix hash): how many rows, and the largest id. All of them, and those met again."""
    level = stage(
        _keyed(docs.select(id_col, text), text, prefix_chars).groupBy(*KEYS).agg(F.count("*").alias("_rows"), F.max(id_col).alias("_id")),
        "dedup-keys",
    )
    return level, level.where("_rows > 1").select(*KEYS)


def _members(docs: DataFrame, shared: DataFrame, id_col: str, text: str, prefix_chars: int, rows: int) -> DataFrame:
    """Documents whose cheap keys are shared, with the full hash and the number of rows that repeat them."""
    candidates = _keyed(docs.select(id_col, text), text, prefix_chars).join(sized(shared, rows), KEYS, "left_semi")
    return stage(
        candidates.select(F.col(id_col).alias("doc_id"), *KEYS, content_hash(F.col("__text")).alias("content_hash"))
        .groupBy("doc_id", *KEYS, "content_hash")
        .agg(F.count("*").alias("n_rows")),
        "dedup-members",
    )


def _decided(members: DataFrame) -> DataFrame:
    groups = stage(  # a stored table, so that the join can split the rows of a large group
        members.groupBy("content_hash").agg(F.max("doc_id").alias("keep_id"), F.sum("n_rows").alias("group_size")),
        "dedup-groups",
    )
    return members.join(groups, "content_hash").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    prefix_chars: int = PREFIX_CHARS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, and how it was told apart.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. The largest id of a
    group stays. ``content_hash`` is null where length and prefix hash alone prove a text to be unique;
    its text is read in full by no step. The two keys (``__length``, ``__prefix``) come with each row.

    A document is an id with a text: rows that repeat both are one document, given once here (and once per
    row by ``text_digests``); ``group_size`` counts rows. One id with two texts is two documents. A null
    id is a document too; it stays only in a group without ids. An empty table gives no rows. Further
    columns are ignored.

    Groups are only ever aggregated, never gathered: a task sends one row per key, however many copies
    it holds, and rows that join their group's result can be split by adaptive execution.
    """
    level, shared = _shared_keys(docs, id_col, text, prefix_chars)
    decided = _decided(_members(docs, shared, id_col, text, prefix_chars, broadcast_rows))
    columns = ["doc_id", "keep_id", "group_size", "kept", "content_hash", *KEYS]
    single = level.where("_rows = 1").select(
        F.col("_id").alias("doc_id"),
        F.col("_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        F.lit(None).cast("string").alias("content_hash"),
        *KEYS,
    )
    return decided.select(*columns).unionByName(single)


def text_digests(docs: DataFrame, result: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The result for every row of the table, those that repeat id and text included, with the SHA-256 of
    the normalised text."""
    digests = (
        _keyed(docs.select(id_col, text), text, PREFIX_CHARS)
        .select(F.col(id_col).alias("_doc"), *[F.col(c).alias(f"{c}_d") for c in KEYS], content_hash(F.col("__text")).alias("text_sha256"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("_doc"))
    for key in KEYS:
        same = same & (F.col(key) == F.col(f"{key}_d"))
    same = same & (F.col("content_hash").isNull() | (F.col("content_hash") == F.col("text_sha256")))
    return result.join(digests, same).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def drop_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    prefix_chars: int = PREFIX_CHARS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """The rows that stay, with all their columns: one per group of equal texts.

    Same rules as ``exact_duplicates``; of rows that repeat id and text, one stays. Texts whose cheap
    keys are unique pass without being hashed.
    """
    _, shared = _shared_keys(docs, id_col, text, prefix_chars)
    keep = _decided(_members(docs, shared, id_col, text, prefix_chars, broadcast_rows)).where("kept")
    keep = stage(keep.select(F.col("doc_id").alias("__keep"), F.col("content_hash").alias("__hash")), "dedup-kept")
    shared = sized(shared, broadcast_rows)
    # the row as one column, so that no column of its own meets those made here
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("__row"), F.col(id_col).alias("__id"), F.col(text).alias("__own"))
    keyed = _keyed(whole, "__own", prefix_chars)
    unique = keyed.join(shared, KEYS, "left_anti").select("__row.*")
    same = F.col("__id").eqNullSafe(F.col("__keep")) & (F.col("__digest") == F.col("__hash"))
    first = (
        keyed.join(shared, KEYS, "left_semi")
        .withColumn("__digest", content_hash(F.col("__text")))
        .join(sized(keep, broadcast_rows), same, "left_semi")
        .dropDuplicates(["__id", "__digest"])
        .select("__row.*")
    )
    return unique.unionByName(first)
