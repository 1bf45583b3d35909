"""Text scalar functions.

Offsets and lengths count code points, as Spark's ``substring`` and ``char_length`` do.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The character classes and factors that decide the results.
WHITESPACE = r"\s\x1c-\x1f\x85\p{Z}"
WHITESPACE_CHARACTERS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
NOT_PRINTABLE = r"[[^\x20-\x7e\t\n]&&[\p{C}\p{Z}]]"  # printable ASCII is passed over without a look at its category
WORD = r"[\p{L}\p{N}_]+"
EXTENSION = r"[^/.][^/]*\.([^/.]*)$"
TOKENS_PER_WORD = 1.3


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def normalize_text(text: Column | str) -> Column:
    """Drop unprintable characters, collapse blanks within lines, drop empty lines.

    Null becomes the empty string. Characters such as NBSP or a zero-width space are removed, not
    turned into a space. The patterns match only what changes, so clean stretches cost no rewrite.
    """
    printable = F.regexp_replace(F.coalesce(_col(text), F.lit("")), NOT_PRINTABLE, "")
    spaced = F.regexp_replace(printable, r"[ \t]{2,}|\t", " ")
    lines = F.regexp_replace(spaced, r" \n[ \n]*|\n[ \n]+", "\n")
    return F.btrim(lines, F.lit(" \n"))


def is_blank(text: Column | str) -> Column:
    """True when the text holds nothing but whitespace (or nothing at all)."""
    return _col(text).rlike(rf"\A[{WHITESPACE}]*\z")


def strip(text: Column | str) -> Column:
    """Remove leading and trailing whitespace of any kind, not only spaces."""
    return F.btrim(_col(text), F.lit(WHITESPACE_CHARACTERS))


def content_hash(text: Column | str) -> Column:
    """SHA-256 of the UTF-8 text, as 64 hexadecimal digits."""
    return F.sha2(_col(text), 256)


def tokens(text: Column | str) -> Column:
    """Lower-cased runs of letters, digits and underscores, in text order."""
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(WORD), F.lit(0))


def word_count(text: Column | str) -> Column:
    """Number of whitespace-separated words; 0 for null."""
    return F.coalesce(F.regexp_count(_col(text), F.lit(rf"[^{WHITESPACE}]+")), F.lit(0))


def token_count(text: Column | str) -> Column:
    """Approximate number of model tokens: 1.3 per word, cut to a whole number."""
    return (word_count(text) * F.lit(TOKENS_PER_WORD)).cast("int")


def file_type(path: Column | str) -> Column:
    """Lower-cased last extension without its dot; empty when the name has none."""
    return F.lower(F.regexp_extract(_col(path), EXTENSION, 1))


def preview(text: Column | str, length: int, always_mark: bool = False) -> Column:
    """First ``length`` characters and ``...``; a text that fits stays unmarked unless asked."""
    text = _col(text)
    cut = F.concat(F.left(text, F.lit(length)), F.lit("..."))
    if always_mark:
        return cut
    return F.when(F.char_length(text) > length, cut).otherwise(text)
