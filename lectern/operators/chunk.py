"""Chunking: documents to overlapping text windows, one row per window.

A text is first cut into consecutive *steps* by one regular expression, in time linear in its
length; a window is its step followed by the first ``overlap`` characters after it. Nothing is
shuffled: the pieces of a document stay in the row until they are exploded.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from lectern.functions.arrays import running_total
from lectern.functions.ids import chunk_id
from lectern.functions.text import content_hash, is_blank, strip, token_count

# Default sizes, and how far back a sentence end is looked for.
FIXED_SIZE, FIXED_OVERLAP = 512, 50
SENTENCE_SIZE, SENTENCE_OVERLAP = 1000, 100
SENTENCE_LOOKBACK = 200
SENTENCE_END = "[.!?]"


def _steps(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s){pattern}"), F.lit(0))


def _window_text(steps: Column, step: Column, position: Column, overlap: int, shortest: int) -> Column:
    """A step and the ``overlap`` characters that follow it, which may span several steps.

    The steps are picked one by one: ``slice`` would copy the whole array for every window.
    """
    if overlap == 0:
        return step
    spanned = math.ceil(overlap / shortest)
    following = F.concat_ws("", *[F.get(steps, position + n) for n in range(1, spanned + 1)])
    return F.concat(step, F.left(following, F.lit(overlap)))


def _explode_kept(windows: DataFrame, carry: list[str]) -> DataFrame:
    """Drop blank windows, number the kept ones from 0 and explode them.

    The outer form with a filter behind it gives the same rows as ``posexplode``, but does not make
    the optimizer evaluate the windows once more in a filter below.
    """
    kept = windows.select(*carry, F.filter("_windows", lambda w: ~is_blank(w["text"])).alias("_kept"))
    counted = kept.select(*carry, F.size("_kept").alias("total_chunks"), "_kept")
    return counted.select(
        *carry,
        "total_chunks",
        F.posexplode_outer("_kept").alias("chunk_index", "_window"),
    ).where("chunk_index IS NOT NULL").select(
        *carry,
        F.col("_window.text").alias("chunk_text"),
        "chunk_index",
        F.col("_window.start").alias("char_start"),
        F.col("_window.end").alias("char_end"),
        "total_chunks",
    )


def fixed_windows(
    documents: DataFrame,
    size: int = FIXED_SIZE,
    overlap: int = FIXED_OVERLAP,
    *,
    text: str = "text",
    carry: list[str] | None = None,
) -> DataFrame:
    """Windows of ``size`` characters, each starting ``size - overlap`` after the one before.

    The last window ends at the end of the text. With ``overlap >= size`` no overlap is possible and
    windows are laid end to end. Blank windows are dropped and not counted in ``chunk_index``.
    """
    if size < 1 or overlap < 0:
        raise ValueError("size must be at least 1 and overlap at least 0")
    if overlap >= size:
        overlap = 0
    carry = ["doc_id"] if carry is None else carry
    step = size - overlap
    length = F.col("_length")
    beyond_first = F.ceil((length - size) / F.lit(float(step))).cast("int")
    cut = documents.select(
        *carry,
        F.char_length(text).alias("_length"),
        _steps(F.col(text), f".{{1,{step}}}").alias("_steps"),
    )
    steps = F.col("_steps")
    windows = cut.select(
        *carry,
        F.transform(
            F.slice(steps, 1, F.when(length <= size, 1).otherwise(1 + beyond_first)),
            lambda piece, i: F.struct(
                (i * step).alias("start"),
                F.least(i * step + size, length).alias("end"),
                _window_text(steps, piece, i, overlap, step).alias("text"),
            ),
        ).alias("_windows"),
    )
    return _explode_kept(windows, carry)


def sentence_windows(
    documents: DataFrame,
    size: int = SENTENCE_SIZE,
    overlap: int = SENTENCE_OVERLAP,
    *,
    text: str = "text",
    carry: list[str] | None = None,
) -> DataFrame:
    """Windows of about ``size`` characters that end after a sentence where one ends near by.

    A text of at most ``size`` characters is one window, left as it is. Otherwise a window that does
    not reach the end of the text is cut after the last ``. ! ?`` among its last 200 characters (the
    character right behind it included), or at ``size`` when there is none; the next window starts
    ``overlap`` before the cut. Windows are stripped; blank ones and blank documents vanish.

    The steps here run from cut to cut. A line end is appended to the text, so that the last step,
    which is what lies behind the last cut, is never empty; stripping removes it again.
    """
    low = max(size - SENTENCE_LOOKBACK, 0) + 1
    step = size - overlap
    if overlap < 0 or low < overlap or step < 1:
        raise ValueError("overlap leaves no room for the windows to advance")
    carry = ["doc_id"] if carry is None else carry
    first = rf"\A(?:.{{{low},{size}}}{SENTENCE_END}|.{{{size}}})"
    later = f"(?=.{{{step + 2}}})(?:.{{{low - overlap},{step}}}{SENTENCE_END}|.{{{step}}})"
    padded = F.concat(text, F.lit("\n"))
    cut = documents.select(
        *carry,
        F.char_length(text).alias("_length"),
        F.when(F.char_length(text) <= size, F.array(padded))
        .otherwise(_steps(padded, f"{first}|{later}|.+"))
        .alias("_steps"),
    )
    steps, length = F.col("_steps"), F.col("_length")
    spanned = math.ceil(overlap / (low + 1 - overlap))

    def with_overlap(piece: Column, i: Column) -> Column:
        """A step with the characters before it, which may span several steps."""
        if overlap == 0:
            return piece
        before = F.concat_ws("", *[F.get(steps, i - n) for n in range(spanned, 0, -1)])
        return F.concat(F.substring(before, -overlap, overlap), piece)

    measured = cut.select(
        *carry,
        "_length",
        F.transform(steps, with_overlap).alias("_texts"),
        F.transform(steps, lambda piece: F.char_length(piece)).alias("_lengths"),
    )
    placed = measured.select(
        *carry,
        "_length",
        "_texts",
        F.transform(
            running_total(F.col("_lengths")), lambda total: F.greatest(total - overlap, F.lit(0))
        ).alias("_starts"),
    )
    last, last_start = F.element_at("_texts", -1), F.element_at("_starts", -1)
    short_tails = F.ceil((length - last_start) / F.lit(float(step))).cast("int") - 1
    windows = placed.select(
        *carry,
        F.concat(
            F.zip_with(
                "_texts",
                "_starts",
                lambda window, start: F.struct(
                    start.alias("start"),
                    F.least(start + F.char_length(window), length).alias("end"),
                    F.when(length <= size, F.left(window, length)).otherwise(strip(window)).alias("text"),
                ),
            ),
            # A last window longer than a step is followed by others that start within it.
            F.when(
                (length > size) & (short_tails > 0),
                F.transform(
                    F.sequence(F.lit(1), short_tails),
                    lambda n: F.struct(
                        (last_start + n * step).alias("start"),
                        length.alias("end"),
                        strip(F.substring(last, n * step + 1, length)).alias("text"),
                    ),
                ),
            ).otherwise(F.array().cast("array<struct<start:int,end:int,text:string>>")),
        ).alias("_windows"),
    )
    return _explode_kept(windows, carry)


STRATEGIES = {"fixed": fixed_windows, "semantic": sentence_windows}


def chunk_documents(
    documents: DataFrame,
    strategy: str = "fixed",
    *,
    carry: list[str] | None = None,
    **options: int,
) -> DataFrame:
    """Chunk rows by a named strategy, with ids, the strategy name and approximate token counts.

    ``carry`` names document columns that travel with the chunks; since they ride along in the row,
    no join with the documents is needed afterwards.
    """
    if strategy not in STRATEGIES:
        raise NotImplementedError(f"no chunking strategy named '{strategy}'; known: {', '.join(STRATEGIES)}")
    carry = carry or []
    chunks = STRATEGIES[strategy](documents, carry=["doc_id", *carry], **options)
    return chunks.select(
        chunk_id("doc_id", F.lit(strategy), "chunk_index", content_hash("chunk_text")).alias("chunk_id"),
        "doc_id",
        "chunk_text",
        "chunk_index",
        "char_start",
        "char_end",
        token_count("chunk_text").alias("token_count"),
        F.lit(strategy).alias("chunking_strategy"),
        *carry,
    )


def enrich_chunks(chunks: DataFrame, documents: DataFrame, columns: list[str]) -> DataFrame:
    """Chunks with columns of their document; chunks whose document is missing keep nulls.

    For chunks read from a table of their own. The document side has one row per id, so a document
    with very many chunks only makes the chunk side uneven, which adaptive execution splits.
    """
    known = documents.select("doc_id", *columns)
    return chunks.join(known, "doc_id", "left").select(*chunks.columns, *columns)
