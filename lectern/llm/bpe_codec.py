"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

A long text is cut before it is encoded, at places that no token can cross: between a character of one of
the pattern's classes and a following one of another, where the pattern holds no alternative with both.
Ids are decoded to the raw bytes of their tokens, so that a token that ends within a character is as good
as any other.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from lectern.llm.common import kept_in_worker, text_slices

# Characters from which a text is cut, and about how many a part has.
LONG = 1 << 16

_SLICE_BYTES = 4 << 20

# Characters that every version of the Unicode tables puts into one class.
_LETTERS = r"A-Za-zÀ-ÖØ-öø-ÿΑ-ΡΣ-ωА-яぁ-ゔァ-ヺ一-龥가-힣"
_DIGITS = "0-9"
_MARKS = r"!-/:-@\[-`{-~、。！，．？"
_BLANKS = r" \n"

# After a letter or digit anything of another class begins a new token; a mark may draw a letter that
# follows into a contraction, and white space belongs to what follows.
_SAFE = regex.compile(
    rf"(?<=[{_LETTERS}])(?=[{_DIGITS}{_MARKS}{_BLANKS}])"
    rf"|(?<=[{_DIGITS}])(?=[{_LETTERS}{_MARKS}{_BLANKS}])"
    rf"|(?<=[{_MARKS}])(?=[{_DIGITS}{_BLANKS}])"
)


def safe_parts(text: str, long: int = LONG) -> Iterator[str]:
    """The text in parts of at least ``long`` characters (the last may be shorter), cut where no token can
    cross. A stretch without such a place stays whole."""
    start = 0
    while len(text) - start > long:
        cut = _SAFE.search(text, start + long)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks, from a file with a line of base64 and number per token."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


class Codec:
    """Ids of texts and bytes of ids for one rank file and pre-tokenizer pattern."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        self.library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})

    def encode(self, text: str, long: int = LONG) -> np.ndarray:
        """Ids of the whole text: special strings are ordinary text."""
        if len(text) <= long:
            return np.array(self.library.encode_ordinary(text), np.uint32)
        return np.concatenate([np.array(self.library.encode_ordinary(p), np.uint32) for p in safe_parts(text, long)])

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens, one after the other. An id beyond the vocabulary raises ``KeyError``."""
        return self.library.decode_bytes(ids.tolist())


def _codec(path: str, pattern: str) -> Codec:
    return kept_in_worker(("codec", path, pattern), lambda: Codec(path, pattern))


def _ids_of(docs: DataFrame, id_col: str) -> str:
    return docs.schema[id_col].dataType.simpleString()


def encode(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text: str = "text", long: int = LONG
) -> DataFrame:
    """doc_id, ids (array of long) of every whole text.

    The ids are those of the tiktoken library for the rank file at ``path`` (on every executor) and the
    pre-tokenizer ``pattern``, without special tokens. Null counts as empty: no ids. Rows that repeat an
    id, and null ids, each give their row; an empty table gives none. Further columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in text_slices(batch.column(1), _SLICE_BYTES):
                codec = _codec(path, pattern)
                ids = [codec.encode(t, long) for t in texts]
                places = np.cumsum([0, *map(len, ids)])
                values = pa.array(np.concatenate(ids).astype(np.int64))
                column = pa.ListArray.from_arrays(pa.array(places, pa.int32()), values)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), column], names=["doc_id", "ids"])
                at += len(texts)

    return docs.select(id_col, text).mapInArrow(run, f"doc_id {_ids_of(docs, id_col)}, ids array<long>")


def decode(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids: str = "ids") -> DataFrame:
    """doc_id, content (bytes) of every array of ids; null and empty arrays give no bytes. Bytes, not text:
    an array of ids may end within a character."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codec = _codec(path, pattern)
                content = [codec.decode(np.array(one or [], np.int64)) for one in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(content, pa.binary())], names=["doc_id", "content"])

    return encoded.select(id_col, ids).mapInArrow(run, f"doc_id {_ids_of(encoded, id_col)}, content binary")


def round_trip_digests(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text: str = "text", long: int = LONG
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of little-endian unsigned 32-bit integers), decoded_sha256 (of the
    decoded bytes), all of whole texts: encoded and decoded as by ``encode`` and ``decode``, whose rules
    hold, but in one pass, so that ids never leave the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            codec = _codec(path, pattern)
            counts, of_ids, of_bytes = [], [], []
            for texts in text_slices(batch.column(1), _SLICE_BYTES):
                for one in texts:
                    ids = codec.encode(one, long)
                    counts.append(len(ids))
                    of_ids.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                    of_bytes.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = f"doc_id {_ids_of(docs, id_col)}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(id_col, text).mapInArrow(run, schema)
