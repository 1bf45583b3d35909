"""Embedding: chunk texts to vectors, by a named encoder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lectern.functions.text import tokens
from lectern.operators.dedup import not_yet_stored
from lectern.operators.ordering import dense_index
from lectern.session import COMPACT

# Default batch size of a plugged-in encoder, and the dimension of the native one.
BATCH_SIZE = 16
HASHED_DIM = 64
HASHED = "hashed-bag-of-words"

# A factory is called once per worker task and returns a function from a list of texts to a
# two-dimensional array, one row per text.
EncoderFactory = Callable[[], Callable[[list], object]]


# Texts of these characters are cut into tokens by the worker: Python and Java agree on which of them are letters
# and digits, and on their lower case (tested). Any other text is cut by the JVM.
PLAIN_TEXT = r"\A[\x00-\u012f\u0131-\u024f]*\z"

# Marks the joined tokens of such a text; no plain text has this character.
CUT = "\uffff"

# Tokens whose bucket a worker remembers: those of texts cut by the JVM, those of plain texts, and the longest of
# them, in characters.
KNOWN_TOKENS, MET_TOKENS, KNOWN_LENGTH = 200_000, 500_000, 64

# Characters that a worker cuts at once; a longer text is cut by itself.
SLICE_CHARS = 1 << 21

_MET: dict = {}


def _met(dim: int) -> list:
    """[tokens, their buckets] that this worker has met in plain texts; kept from task to task, and never empty."""
    import numpy as np

    return _MET.setdefault(dim, [pa.array([b""], pa.large_binary()), np.zeros(1, np.int64)])


def _counter(dim: int):
    """Arrow arrays of texts, or of marked lists of their tokens, to arrays of counts per bucket.

    Plain texts are cut together, as arrays of character codes, and their tokens are looked up together, among
    those met before; only the others are hashed one by one.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import hashlib
        import re

        import numpy as np
        import pyarrow.compute as pc

        known, met = {}, _met(dim)
        lowered = np.zeros(0x250, np.uint16)  # of a character of a plain text that belongs to tokens; 0 for the others
        for code in range(len(lowered)):
            if len(low := chr(code).lower()) == 1 and re.match(r"\w", low):
                lowered[code] = ord(low)

        def hashed(token: str) -> int:
            return int.from_bytes(hashlib.md5(token.encode()).digest()[:4], "big") % dim

        def bucket(token: str) -> int:
            number = hashed(token)
            if len(token) <= KNOWN_LENGTH:
                if len(known) >= KNOWN_TOKENS:
                    known.clear()
                known[token] = number
            return number

        def found(words: pa.Array) -> np.ndarray:
            """The buckets of UTF-16 tokens."""
            tokens_met, buckets = met
            at = pc.index_in(words, value_set=tokens_met)
            numbers = buckets[at.fill_null(0).to_numpy()]
            if at.null_count:
                other = words.filter(at.is_null()).dictionary_encode()
                fresh = other.dictionary
                their = np.array([hashed(token.decode("utf-16-le")) for token in fresh.to_pylist()], np.int64)
                numbers[at.is_null().to_numpy(zero_copy_only=False)] = their[other.indices.to_numpy()]
                if len(tokens_met) + len(fresh) > MET_TOKENS:  # those that occur here stay
                    used = np.union1d([0], at.drop_null().to_numpy())[:MET_TOKENS]
                    tokens_met, buckets = tokens_met.take(pa.array(used)), buckets[used]
                room = np.arange(len(fresh)) < MET_TOKENS - len(tokens_met)
                short = room & (pc.binary_length(fresh).to_numpy() <= 2 * KNOWN_LENGTH)
                kept = pa.concat_arrays([tokens_met, fresh.filter(pa.array(short))])
                met[:] = kept, np.concatenate([buckets, their[short]])
            return numbers

        def slices(texts: list) -> Iterator[list]:
            part, held = [], 0
            for text in texts:
                if part and held + len(text) > SLICE_CHARS:
                    yield part
                    part, held = [], 0
                part.append(text)
                held += len(text)
            if part:
                yield part

        def counted(part: list) -> np.ndarray:
            plain = ["" if text.startswith(CUT) else text for text in part]
            low = lowered[np.frombuffer("\n".join(["", *plain, ""]).encode("utf-16-le"), np.uint16)]
            inside = low != 0
            edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
            starts, ends = edges[::2], edges[1::2]
            behind = np.cumsum(np.fromiter(map(len, plain), np.int64, len(plain)) + 1)  # where each text ends
            row = np.repeat(np.arange(len(part)), np.diff(np.searchsorted(starts, behind), prepend=0))
            offsets = 2 * np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
            buffers = [None, pa.py_buffer(offsets), pa.py_buffer(low[inside])]
            words = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers)
            counts = np.bincount(row * dim + found(words), minlength=len(part) * dim)
            for at, text in enumerate(part):
                if text.startswith(CUT) and len(text) > 1:
                    for token in text[1:].split(" "):
                        number = known.get(token)
                        counts[at * dim + (bucket(token) if number is None else number)] += 1
            return counts.astype(np.float32)

        for texts in batches:
            counts = np.concatenate([np.empty(0, np.float32), *map(counted, slices(texts.to_pylist()))])
            starts = np.arange(0, len(counts) + 1, dim, dtype=np.int32)
            yield pa.ListArray.from_arrays(pa.array(starts), pa.array(counts))

    return run


def embed_hashed(df: DataFrame, text: str = "chunk_text", vector: str = "embedding", dim: int = HASHED_DIM) -> DataFrame:
    """The native encoder: token counts hashed into ``dim`` buckets (the first 32 bits of a token's MD5, modulo ``dim``).

    A worker cuts the texts and remembers the buckets of the tokens it has met; texts with characters on which
    the JVM and Python may differ are cut by the JVM. A null text has an empty vector.
    """
    count = F.arrow_udf(_counter(dim), "array<float>")
    given = F.coalesce(text, F.lit(""))
    plain = (F.octet_length(given) == F.char_length(given)) | given.rlike(PLAIN_TEXT)  # ASCII is seen without a pattern
    sent = F.when(plain, given).otherwise(F.concat(F.lit(CUT), F.array_join(tokens(given), " ")))
    none = F.array().cast("array<float>")
    return df.select("*", F.when(F.col(text).isNotNull(), count(sent)).otherwise(none).alias(vector))


def embed_with(
    df: DataFrame,
    factory: EncoderFactory,
    dim: int,
    text: str = "chunk_text",
    vector: str = "embedding",
    batch_size: int = BATCH_SIZE,
) -> DataFrame:
    """Vectors from a plugged-in encoder, in Python workers over Arrow batches.

    Each task loads the encoder once and feeds it ``batch_size`` texts at a time. When it runs out of
    memory, the batch size is halved and the batch tried again; at 1 the error stands. An output of
    another width than ``dim`` fails the job.
    """

    def encode(batches: Iterator) -> Iterator:
        import numpy as np

        encoder = factory()
        size = batch_size
        for batch in batches:
            texts = batch[text].tolist()
            vectors, start = [], 0
            while start < len(texts):
                try:
                    block = np.asarray(encoder(texts[start : start + size]), dtype=np.float32)
                except (MemoryError, RuntimeError) as error:
                    short = isinstance(error, MemoryError) or "out of memory" in str(error).lower()
                    if not short or size == 1:
                        raise
                    size = max(size // 2, 1)
                    continue
                if block.ndim != 2 or block.shape[1] != dim:
                    raise ValueError(f"encoder returned shape {block.shape}, expected width {dim}")
                vectors.extend(block)
                start += size
            yield batch.assign(**{vector: vectors})

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != vector]
    return df.mapInPandas(encode, ", ".join([*fields, f"`{vector}` array<float>"]))


class Encoders:
    """Encoders by model name; the native one is always there."""

    def __init__(self) -> None:
        self._known: dict[str, tuple[EncoderFactory | None, int]] = {HASHED: (None, HASHED_DIM)}

    def add(self, name: str, factory: EncoderFactory, dim: int) -> None:
        self._known[name] = (factory, dim)

    def dim(self, name: str) -> int:
        return self._known[name][1]

    def embed(self, df: DataFrame, name: str, text: str = "chunk_text", batch_size: int = BATCH_SIZE) -> DataFrame:
        """The rows with their vector, the model's name and its dimension."""
        if name not in self._known:
            raise ValueError(f"Unknown model '{name}'")
        factory, dim = self._known[name]
        if factory is None:
            embedded = embed_hashed(df, text, dim=dim)
        else:
            embedded = embed_with(df, factory, dim, text, batch_size=batch_size)
        return embedded.withColumn("model_name", F.lit(name)).withColumn("embedding_dim", F.lit(dim))


def not_yet_embedded(chunks: DataFrame, stored: DataFrame, model_name: str) -> DataFrame:
    """Chunks the named model has no stored vector for."""
    done = stored.where(F.col("model_name") == model_name)
    return not_yet_stored(chunks, done, "chunk_id")


def embedding_index(embedded: DataFrame, at: Column) -> DataFrame:
    """(chunk_id, embedding_index, model_name, embedding_dim, embedding_timestamp) in chunk_id order."""
    slim = embedded.select("chunk_id", "model_name", "embedding_dim")
    return dense_index(slim, "chunk_id", "embedding_index", "embedding-index", COMPACT).select(
        "chunk_id", "embedding_index", "model_name", "embedding_dim", at.alias("embedding_timestamp")
    )
