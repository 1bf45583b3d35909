"""Content-derived identifiers: the same input always gets the same id, on any run or executor."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: unit separator between the parts of an id, so that ("ab", "c") differs from ("a", "bc").
SEPARATOR = "\x1f"


def stable_id(*parts: Column | str) -> Column:
    """36-character id (8-4-4-4-12 hexadecimal digits) from the SHA-256 of the parts."""
    text = F.concat_ws(SEPARATOR, *[(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts])
    return F.regexp_replace(
        F.left(F.sha2(text, 256), F.lit(32)),
        "^(.{8})(.{4})(.{4})(.{4})(.{12})$",
        "$1-$2-$3-$4-$5",
    )


def document_id(source_path: Column | str, text_hash: Column | str) -> Column:
    return stable_id(source_path, text_hash)


def chunk_id(
    doc_id: Column | str, strategy: Column | str, chunk_index: Column | str, text_hash: Column | str
) -> Column:
    """The hash of the chunk's own text is part of its id: cut a document another way, and whatever was
    stored for an id still belongs to the same text."""
    return stable_id(doc_id, strategy, chunk_index, text_hash)
