"""Parsing: file bytes to text, with failures as rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, functions as F

from lectern.functions.ids import document_id
from lectern.functions.text import content_hash, is_blank, normalize_text
from lectern.sources.files import PAGED_TYPES, TEXT_TYPES

# The version that is stored with every document, the wording of errors and placeholders.
PARSER_VERSION = "1.0.0"
UNSUPPORTED = "Unsupported file type: "
UNEXPECTED = "Unexpected error: "
NO_EXTRACTOR = "no extractor for paged files"
PLACEHOLDER = "[PDF file: %s - Error reading: %s]"

# An extractor turns the bytes of one paged file into the texts of its pages, None for a page that
# failed; it raises if the file cannot be read at all.
Extractor = Callable[[bytes], list]

_PAGES = "source_path string, file_type string, file_size_bytes long, pages array<string>, error string"


def decode_text(content: Column | str) -> Column:
    """Bytes as UTF-8, or the whole file as Latin-1 if they are not valid; line ends become ``\\n``."""
    content = F.col(content) if isinstance(content, str) else content
    utf8 = content.cast("string")
    text = F.when(F.is_valid_utf8(utf8), utf8).otherwise(F.decode(content, "ISO-8859-1"))
    return F.regexp_replace(text, "\r\n?", "\n")


def join_pages(pages: Column | str) -> Column:
    """Page texts in order, a line each; failed and empty pages are left out."""
    return F.array_join(F.filter(pages, lambda page: page.isNotNull() & (page != "")), "\n")


def extract_pages(files: DataFrame, extractor: Extractor) -> DataFrame:
    """(source_path, file_type, file_size_bytes, pages, error) of paged files.

    The extractor runs in Python workers over Arrow batches; an error it raises becomes the row's error.
    """

    def pages_of(batches: Iterator) -> Iterator:
        import pandas as pd

        def attempt(content):
            try:
                return list(extractor(bytes(content))), None
            except Exception as error:  # any defect of one file is that file's failure
                return None, f"{error}"

        for batch in batches:
            results = [attempt(content) for content in batch["content"]]
            yield batch[["source_path", "file_type", "file_size_bytes"]].assign(
                pages=pd.Series([pages for pages, _ in results], index=batch.index, dtype=object),
                error=pd.Series([error for _, error in results], index=batch.index, dtype=object),
            )

    return files.mapInPandas(pages_of, _PAGES)


_CARRY = ["source_path", "file_type", "file_size_bytes"]


def _parsed(rows: DataFrame) -> DataFrame:
    return rows.select(
        *_CARRY,
        "text",
        "page_count",
        F.col("text").isNotNull().alias("parse_success"),
        "error_message",
    )


def parse_text(files: DataFrame) -> DataFrame:
    """Parsed rows of text files, decoded natively, one page each; other types are error rows."""
    is_text = F.col("file_type").isin(*TEXT_TYPES)
    return _parsed(
        files.select(
            *_CARRY,
            F.when(is_text, decode_text("content")).alias("text"),
            F.when(is_text, F.lit(1)).alias("page_count"),
            F.when(~is_text, F.concat(F.lit(UNSUPPORTED), "file_type")).alias("error_message"),
        )
    )


def parse_paged(files: DataFrame, extractor: Extractor | None) -> DataFrame:
    """Parsed rows of paged files; without an extractor every one is an error row."""
    if extractor is None:
        pages = files.select(
            *_CARRY,
            F.lit(None).cast("array<string>").alias("pages"),
            F.lit(NO_EXTRACTOR).alias("error"),
        )
    else:
        pages = extract_pages(files, extractor)
    return _parsed(
        pages.select(
            *_CARRY,
            join_pages("pages").alias("text"),
            F.when(F.col("error").isNull(), F.size("pages")).alias("page_count"),
            F.concat(F.lit(UNEXPECTED), "error").alias("error_message"),
        )
    )


def parse_files(files: DataFrame, extractor: Extractor | None = None) -> DataFrame:
    """(source_path, file_type, file_size_bytes, text, page_count, parse_success, error_message)
    of files of any type, each parsed the way its type asks for."""
    paged = F.col("file_type").isin(*PAGED_TYPES)
    return parse_text(files.where(~paged)).unionByName(parse_paged(files.where(paged), extractor))


def failures(parsed: DataFrame, at: Column) -> DataFrame:
    """Quarantine rows of the files that could not be parsed."""
    return parsed.where(~F.col("parse_success")).select(
        "source_path", "file_type", F.col("error_message").alias("error"), at.alias("timestamp")
    )


def successes(parsed: DataFrame) -> DataFrame:
    return parsed.where("parse_success").drop("parse_success", "error_message")


def with_placeholder(parsed: DataFrame) -> DataFrame:
    """Keep unreadable files as documents whose text says so; drop files whose text is blank."""
    name = F.regexp_extract("source_path", r"([^/]*)$", 1)
    placeholder = F.format_string(PLACEHOLDER, name, F.col("error_message"))
    text = F.coalesce(F.col("text"), placeholder)
    return parsed.withColumn("text", text).where(~is_blank("text"))


def normalized(parsed: DataFrame) -> DataFrame:
    """Parsed rows with their text normalised and its hash; both stay null for failures."""
    text = F.when(F.col("parse_success"), normalize_text("text"))
    return parsed.withColumn("text", text).withColumn("hash", content_hash("text"))


def to_documents(ready: DataFrame, at: Column) -> DataFrame:
    """Normalised rows as rows of the documents table, before duplicates are removed."""
    return successes(ready).select(
        document_id("source_path", "hash").alias("doc_id"),
        "source_path",
        "text",
        "hash",
        "file_type",
        "file_size_bytes",
        "page_count",
        at.alias("ingestion_timestamp"),
        F.lit(PARSER_VERSION).alias("parser_version"),
    )
