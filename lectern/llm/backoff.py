"""Language-model scores with stupid backoff.

The n-grams of all documents are counted in tables partitioned by a hash of the n-gram, and the
n-grams of the documents are joined to them. The rows that travel are not single n-grams: a chunk of
neighbouring documents counts its own n-grams first and sends a partition one row with the distinct
ones it has for it, if any, so that a word found in every document is one entry per chunk. The partition sums them, and sends
the totals back to the chunk, where they are looked up for each document and summed. Sorted keys travel as their gaps, and the
texts of a chunk as one compressed block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

ORDER = 3
ALPHA = 0.4

# Documents of a chunk, as a power of two; bytes of a text that is a chunk of its own; bytes of text per
# partition of the count tables.
CHUNK_BITS = 11
LONG_BYTES = 1 << 16
PARTITION_BYTES = 6 << 20

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9))
# How keys and texts are compressed; texts at a higher level, since they are read once.
_CODEC, _TEXT_LEVEL = "zstd", 6
_COUNTS = "chunk long, part int, words long, keys binary, counts binary"
_TOTALS = "chunk long, part int, words long, totals binary"


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """64-bit hash of a pair of 64-bit hashes, in order."""
    h = (left * _MIX[0]) ^ (right + _MIX[1] + (left << np.uint64(6)) + (left >> np.uint64(2)))
    h = (h ^ (h >> np.uint64(31))) * _MIX[1]
    return h ^ (h >> np.uint64(29))


class _Hashes(dict):
    """Words to their hashes, each computed once."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = xxhash.xxh64_intdigest(word)
        return number


class Grams:
    """All n-grams of a chunk's texts, order by order, with the document each belongs to."""

    def __init__(self, texts: list[bytes], order: int):
        hashed = _Hashes().__getitem__
        split = [np.fromiter(map(hashed, t.lower().split()), np.uint64) for t in texts]
        self.lengths = np.fromiter(map(len, split), np.int64, len(split))
        words = np.concatenate([*split, np.zeros(0, np.uint64)])
        del split
        owner = np.repeat(np.arange(len(texts), dtype=np.int32), self.lengths)
        # per order: the n-grams, their documents, and the place of the word at which each ends
        keys, self.owners, self.ends = [words], [owner], [np.arange(len(words), dtype=np.int32)]
        for n in range(2, order + 1):
            ends = np.flatnonzero(owner[n - 1 :] == owner[: max(0, len(owner) - n + 1)]).astype(np.int32) + np.int32(n - 1)
            self.ends.append(ends)
            self.owners.append(owner[ends])
            keys.append(_mixed(keys[n - 2][self.context(n)], words[ends]))
        self.all = np.concatenate(keys)

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct n-grams in order, and how often each is there."""
        return np.unique(self.all, return_counts=True)

    def numbered(self) -> np.ndarray:
        """Per n-gram, its place among the distinct ones."""
        order = np.argsort(self.all)
        ranked = self.all[order]
        number = np.zeros(len(order), np.int32)
        number[1:] = np.cumsum(ranked[1:] != ranked[:-1])
        out = np.empty(len(order), np.int32)
        out[order] = number
        return out

    def context(self, n: int) -> np.ndarray:
        """Per n-gram, the row of the shorter one before its last word."""
        return np.searchsorted(self.ends[n - 2], self.ends[n - 1] - np.int32(1))


def _bounds(distinct: np.ndarray, parts: int) -> np.ndarray:
    """Where each partition begins in the sorted keys: equal ranges of the hash."""
    edges = np.array([i * (1 << 64) // parts for i in range(1, parts)], np.uint64)
    return np.r_[0, np.searchsorted(distinct, edges), len(distinct)]


def _packed(values: np.ndarray) -> bytes:
    """Numbers as their first bytes, their second ones and so on, each kind compressed on its own: high bytes are
    mostly zero, and the low ones of hashes are as good as random. Nothing is kept of kinds that are zero."""
    kinds = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    parts = [pa.compress(kind.tobytes(), codec=_CODEC, asbytes=True) if kind.any() else b"" for kind in kinds]
    return np.array([len(values), *map(len, parts)], "<u4").tobytes() + b"".join(parts)


def _unpacked(data: bytes) -> np.ndarray:
    head = np.frombuffer(data, "<u4", 9).astype(np.int64)
    kinds, cuts = np.zeros((8, head[0]), np.uint8), 36 + np.cumsum([0, *head[1:]])
    for kind, a, b in zip(kinds, cuts, cuts[1:], strict=False):
        if b > a:
            kind[:] = np.frombuffer(pa.decompress(data[a:b], int(head[0]), codec=_CODEC, asbytes=True), np.uint8)
    return np.ascontiguousarray(kinds.T).view("<u8").reshape(-1)


def _packed_sorted(values: np.ndarray) -> bytes:
    return _packed(np.diff(values, prepend=np.zeros(1, values.dtype)))


def _unpacked_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data), dtype=np.uint64)


def _block(rows: pa.Table) -> bytes:
    """The rows as one compressed block."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec(_CODEC, _TEXT_LEVEL))) as out:
        out.write_table(rows.combine_chunks())
    return sink.getvalue().to_pybytes()


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """The chunks of a scan's task, whose rows come one after the other, but for long texts among them."""
    held, key = [], None
    for batch in batches:
        column = batch.column(0).to_numpy()
        cuts = np.r_[0, np.flatnonzero(np.diff(column)) + 1, len(column)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b <= a:
                continue
            part = batch.slice(a, b - a)
            if column[a] < 0:
                yield int(column[a]), pa.Table.from_batches([part])
                continue
            if held and column[a] != key:
                yield key, pa.Table.from_batches(held)
                held = []
            key = int(column[a])
            held.append(part)
    if held:
        yield key, pa.Table.from_batches(held)


def _texts(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).fill_null(b"").to_pylist()


def _scores(grams: Grams, totals: np.ndarray, words: int, order: int, alpha: float) -> np.ndarray:
    """Sum of log10 scores per document, its own n-grams left out of the counts."""
    documents = len(grams.lengths)
    rows = np.cumsum([0, *map(len, grams.ends)])
    number = grams.numbered()
    if len(totals) != (int(number.max()) + 1 if len(number) else 0):
        raise ValueError("the rows of a chunk changed between two scans: store the table first")
    elsewhere = totals[number]
    for a, b, owner in zip(rows, rows[1:], grams.owners, strict=False):
        pair = owner * np.int64(len(totals) + 1) + number[a:b]
        _, inverse, counts = np.unique(pair, return_inverse=True, return_counts=True)
        elsewhere[a:b] -= counts[inverse]
    others = (words - grams.lengths)[grams.owners[0]].astype(np.float64)
    uni = elsewhere[rows[0] : rows[1]]
    # a word that no other document has counts as half a word
    score = np.log10(np.where(uni > 0, uni, 0.5)) - np.log10(np.maximum(others, 1))
    for n in range(2, order + 1):
        longer = elsewhere[rows[n - 1] : rows[n]]
        shorter = elsewhere[rows[n - 2] : rows[n - 1]][grams.context(n)]
        seen, ends = longer > 0, grams.ends[n - 1]
        score[ends] += np.log10(alpha)
        score[ends[seen]] = np.log10(longer[seen]) - np.log10(shorter[seen])
    return np.bincount(grams.owners[0], weights=score, minlength=documents).astype(np.float64)


def backoff_scores(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    order: int = ORDER,
    alpha: float = ALPHA,
    parts: int | None = None,
    chunk_bits: int = CHUNK_BITS,
) -> DataFrame:
    """doc_id, n_words, log_score (sum of log10 scores over the words), mean_log_score.

    Words stand between ASCII white space, with A-Z in lower case. The score of a word after its context
    is count(context, word) / count(context); if the n-gram is not found, ``alpha`` times the score with
    a context shorter by one word; at last count(word) / words. All counts are over all other documents,
    the document's own n-grams subtracted; a word that occurs nowhere else counts as half a word.

    A null text is empty; texts without words have sum 0 and mean null. Rows that repeat an id are
    documents of their own. An empty table gives no rows. Further columns are ignored.

    Documents keep their chunk by their place in the scan, so ``docs`` should be a stored table or one
    whose rows come in the same order twice; a chunk whose n-grams do not fit its totals is an error.
    """
    place = F.monotonically_increasing_id()
    long = F.coalesce(F.octet_length(F.col(text)), F.lit(0)) > LONG_BYTES
    chunk = F.when(long, -1 - place).otherwise(F.shiftright(place, chunk_bits))
    base = docs.select(chunk.alias("chunk"), F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    if parts is None:
        size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
        parts = max(1, -(-size // PARTITION_BYTES))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per chunk and partition that it has n-grams for, and one, numbered behind them, with its words."""
        for key, rows in _chunks(batches):
            grams = Grams(_texts(rows.column("text")), order)
            distinct, counts = grams.counted()
            cuts = _bounds(distinct, parts)
            spans = [(i, a, b) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a]
            none = np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_pydict(
                {
                    "chunk": pa.array([key] * (len(spans) + 1), pa.int64()),
                    "part": pa.array([*(i for i, _, _ in spans), parts], pa.int32()),
                    "words": pa.array([0] * len(spans) + [int(grams.lengths.sum())], pa.int64()),
                    "keys": pa.array([*(_packed_sorted(distinct[a:b]) for _, a, b in spans), _packed(none)], pa.binary()),
                    "counts": pa.array([*(_packed(counts[a:b]) for _, a, b in spans), _packed(none)], pa.binary()),
                }
            )

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows in _chunks(batches):
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([key], pa.int64()), "rows": pa.array([_block(rows)], pa.binary())})

    def total(rows: pa.Table) -> pa.Table:
        keys = [_unpacked_sorted(k) for k in rows.column("keys").to_pylist()]
        counts = [_unpacked(c) for c in rows.column("counts").to_pylist()]
        _, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        sums = np.bincount(inverse, weights=np.concatenate(counts)).astype("<i8")
        back = sums[inverse]
        cuts = np.cumsum([0, *map(len, keys)])
        words = sum(rows.column("words").to_pylist())
        return pa.table(
            {
                "chunk": rows.column("chunk"),
                "part": rows.column("part"),
                "words": pa.array([words] * rows.num_rows, pa.int64()),
                "totals": pa.array([_packed(back[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()),
            }
        )

    def score(block: pa.Table, totals: pa.Table) -> pa.Table:
        documents = pa.ipc.open_stream(block.column("rows")[0].as_py()).read_all()
        grams = Grams(_texts(documents.column("text")), order)
        rows = totals.sort_by("part")
        joined = np.concatenate([_unpacked(t) for t in rows.column("totals").to_pylist()]).astype(np.int64)
        sums = _scores(grams, joined, rows.column("words")[-1].as_py(), order, alpha)
        mean = pa.array(sums / np.maximum(grams.lengths, 1), mask=grams.lengths == 0)
        return pa.table(
            {"doc_id": documents.column("doc_id"), "n_words": grams.lengths, "log_score": sums, "mean_log_score": mean}
        )

    counts = base.mapInArrow(counted, _COUNTS)
    totals = counts.repartition(parts, "part").groupBy("part").applyInArrow(total, _TOTALS)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, log_score double, mean_log_score double"
    stored = base.mapInArrow(blocks, "chunk long, rows binary")
    return stored.groupBy("chunk").cogroup(totals.groupBy("chunk")).applyInArrow(score, schema)
