"""Token ids as flat binary files: unsigned integers, and 64-bit document offsets beside them.

Every partition writes three files: ``tokens-*.bin`` (little-endian, 16 bits if the vocabulary allows,
else 32), ``offsets-*.bin`` (64 bits, tokens of the file before each document, and the total at the
end) and ``ids-*.arrow`` (the document ids in order). The manifest has one row per partition; the
base of a partition, the tokens of all partitions before it, is the prefix sum over the manifest.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window, functions as F

from lectern.llm.common import kept_in_worker, release_memory, text_slices
from lectern.llm.pieces import Pieces, spelled
from lectern.session import shared_dir, stage

END_ID = 0

# Pieces whose ids a worker remembers, in two halves: when the younger one is full, the older one is forgotten. And bytes
# of text in work at a time.
CACHE_PIECES = 1_000_000
_SLICE_BYTES = 8 << 20
_JOINED_PIECES, _JOINED_TEXTS = 256, 64

_MANIFEST = (
    "part int, tokens_file string, offsets_file string, ids_file string, width int, documents long, tokens long"
)


def id_width(path: str) -> int:
    """Bytes per id: two if every id of the vocabulary file fits, else four."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    largest = max([*content["model"]["vocab"].values(), *(t["id"] for t in content["added_tokens"])])
    return 2 if largest < 1 << 16 else 4


# Marks that end many words. After a Latin letter, one of them at the end of a piece is a token of its own.
_MARKS = frozenset(".,;:!?")
_LAST_LATIN = "\u024f"
# The vocabulary's letters for a space and a line feed.
_BLANK_LETTERS = "\u0120\u010a"


class _Encoder:
    """Ids of whole texts as bytes, from the library's ids of their pieces."""

    def __init__(self, path: str, width: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.kind = np.dtype(f"<u{width}")
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        vocabulary = self.library.get_vocab()
        self.begins_blank = np.zeros(max(vocabulary.values()) + 1, bool)
        self.begins_blank[[i for token, i in vocabulary.items() if token[0] in _BLANK_LETTERS]] = True

    def _bytes(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def _each(self, texts: list[str]) -> list[bytes]:
        return [self._bytes(e.ids) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, parts: set[str]) -> None:
        """A word with a mark at its end has the ids of the word and of the mark; see ``_MARKS``."""
        marked = [p for p in parts if p[-1:] in _MARKS and p[-2:-1].isalpha() and p[-2] <= _LAST_LATIN]
        words = parts.difference(marked).union(p[:-1] for p in marked).difference(self.known)
        alone = [p for p in words if not p or p == "\n"]
        self.known.update(zip(alone, self._each([spelled(p) for p in alone]), strict=True))
        rest = [p for p in words if p and p != "\n"]
        step = _JOINED_PIECES * _JOINED_TEXTS
        for i in range(0, len(rest), step):
            self._learn_joined(rest[i : i + step])
        ends = dict(zip(sorted(_MARKS), self._each(sorted(_MARKS)), strict=True))
        self.known.update((p, self.known[p[:-1]] + ends[p[-1]]) for p in marked)

    def _learn_joined(self, parts: list[str]) -> None:
        """Pieces that begin with white space and hold no other keep their ids side by side, so many are
        encoded in one text. A piece begins at each id whose token begins with white space."""
        runs = [parts[i : i + _JOINED_PIECES] for i in range(0, len(parts), _JOINED_PIECES)]
        joined = ["".join([spelled(p) for p in run]) for run in runs]
        ids = np.concatenate([np.array(e.ids) for e in self.library.encode_batch_fast(joined, add_special_tokens=False)])
        cuts = (np.r_[np.flatnonzero(self.begins_blank[ids]), len(ids)] * self.kind.itemsize).tolist()
        data = ids.astype(self.kind).tobytes()
        self.known.update(zip(parts, [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], strict=True))

    def encode(self, texts: list[str]) -> list[bytes | memoryview]:
        """The ids of each text. A piece is looked up once per batch, and the ids of all texts are then
        gathered at once."""
        pieces = Pieces(texts)
        new = set(pieces.names).difference(self.known)
        if again := new.intersection(self.older):
            self.known.update((p, self.older[p]) for p in again)
            new -= again
        if 2 * (len(self.known) + len(new)) > CACHE_PIECES:  # what is in use comes back from the older half
            self.older, self.known = self.known, {p: self.known[p] for p in pieces.names if p in self.known}
        self._learn(new)
        first = list(set(pieces.first).union(*pieces.odd.values()))
        starts = dict(zip(first, self._each(first), strict=True))
        out: list[bytes | memoryview] = [b""] * len(texts)
        if pieces.plain:
            begun = list(dict.fromkeys(pieces.first))
            table = [*map(self.known.__getitem__, pieces.names), *map(starts.__getitem__, begun)]
            at = {p: len(pieces.names) + i for i, p in enumerate(begun)}
            numbers = pieces.numbers.copy()
            numbers[pieces.offsets[:-1]] = [at[p] for p in pieces.first]
            gathered = pa.array(table, pa.large_binary()).take(pa.array(numbers))
            _, ends, data = gathered.buffers()
            cuts = np.frombuffer(ends, np.int64)[pieces.offsets].tolist()
            data = memoryview(data).cast("B") if data else memoryview(b"")
            for i, a, b in zip(pieces.plain, cuts, cuts[1:], strict=False):
                out[i] = data[a:b]
        for i, parts in pieces.odd.items():
            out[i] = b"".join(map(starts.__getitem__, parts))
        return out


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def write_token_files(
    docs: DataFrame,
    folder: str,
    path: str,
    id_col: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    partitions: int | None = None,
) -> DataFrame:
    """Encode whole texts and write them in ascending id order; returns the manifest with the bases.

    ``folder`` is one that all executors share; ``path``, the tokenizer's file, is on each of them. A
    null text has the end id only; null ids come first. Rows that repeat an id stand next to each other
    in any order. An empty table writes no files, and its manifest has no rows.

    A task writes files of its own name, and only the names that successful tasks return are in the
    manifest, so a lost executor's files are left over but never read.
    """
    width = id_width(path)
    columns = [F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")]
    chosen = docs.select(*columns)
    ordered = chosen.repartitionByRange(partitions, "id") if partitions else chosen.repartitionByRange("id")
    ordered = ordered.sortWithinPartitions("id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, ids, offsets = None, [], [0]
        name = uuid.uuid4().hex
        files = [f"tokens-{name}.bin", f"offsets-{name}.bin", f"ids-{name}.arrow"]
        end = np.array([end_id], f"<u{width}").tobytes()
        out = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                store, base = _open(folder)
                store.create_dir(base, recursive=True)
                encoder = kept_in_worker(("encoder", path, width), lambda: _Encoder(path, width))
                out = store.open_output_stream(f"{base}/{files[0]}")
            ids.append(batch.column(0))
            for texts in text_slices(batch.column(1), _SLICE_BYTES):
                ids_of = encoder.encode(texts)
                out.write(b"".join(x for one in ids_of for x in (one, end)))
                offsets += (offsets[-1] + np.cumsum([len(one) // width + 1 for one in ids_of])).tolist()
        if out is None:
            return
        out.close()
        with store.open_output_stream(f"{base}/{files[1]}") as file:
            file.write(np.array(offsets, "<i8").tobytes())
        column = pa.chunked_array(ids)
        with store.open_output_stream(f"{base}/{files[2]}") as file:
            with pa.ipc.new_file(file, pa.schema([("id", column.type)])) as writer:
                writer.write_table(pa.table({"id": column}))
        row = [[TaskContext.get().partitionId()], *[[f] for f in files], [width], [len(offsets) - 1], [offsets[-1]]]
        kinds = [pa.int32(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
        names = [c.split()[0] for c in _MANIFEST.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], names=names)
        release_memory()

    written = stage(ordered.mapInArrow(run, _MANIFEST), "token-manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    return written.withColumns(
        {
            "base": F.coalesce(F.sum("tokens").over(before), F.lit(0)),
            "first_document": F.coalesce(F.sum("documents").over(before), F.lit(0)),
        }
    )


def map_file(folder: str, name: str, kind: str) -> np.ndarray:
    """A flat file as an array: memory-mapped if it is on a mounted disk, else read."""
    store, base = _open(folder)
    where = f"{base}/{name}"
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(where, kind, "r") if os.path.getsize(where) else np.zeros(0, kind)
    with store.open_input_file(where) as file:
        return np.frombuffer(file.read(), kind)


def _ids(folder: str, name: str) -> pa.ChunkedArray:
    store, base = _open(folder)
    with store.open_input_file(f"{base}/{name}") as file:
        return pa.ipc.open_file(file).read_all().column(0)


def read_documents(manifest: DataFrame, folder: str, id_type: str = "bigint") -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32 (of 32-bit ids)."""
    rows = manifest.select("base", "tokens_file", "offsets_file", "ids_file", "width")
    spread = rows.repartition(max(1, manifest.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, tokens_file, offsets_file, ids_file, width in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                tokens = map_file(folder, tokens_file, f"<u{width}")
                offsets = map_file(folder, offsets_file, "<i8")
                ids = _ids(folder, ids_file).combine_chunks()
                for a in range(0, len(ids), 10_000):
                    part = ids[a : a + 10_000]
                    places = offsets[a : a + len(part) + 1]
                    sums = [zlib.crc32(tokens[x:y].astype("<u4").tobytes()) for x, y in zip(places, places[1:], strict=False)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            part,
                            pa.array(places[:-1] + base),
                            pa.array(np.diff(places)),
                            pa.array(sums, pa.int64()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    return spread.mapInArrow(run, f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long")


def token_folder(spark) -> str:
    """A fresh folder in the shared one."""
    return f"{shared_dir(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"
