"""Token counts of byte-level BPE, by merging all distinct pre-tokens of a batch at once.

The pre-tokens lie one after the other in flat arrays, as symbols with the number of their sequence.
In every round each sequence finds the lowest rank among its neighbouring pairs and merges all pairs
of that rank, from the left; a sequence without a known pair is finished, and the symbols it has left
are its tokens.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from lectern.llm.common import kept_in_worker, text_slices
from lectern.llm.pieces import Pieces, spelled

# Tokens above which a document does not fit one context.
LIMIT = 1024

# Pieces whose counts a task remembers before it forgets those not in use, and bytes of text in work at a time.
CACHE_PIECES = 600_000
_SLICE_BYTES = 4 << 20

_PAIR_BASE = np.int64(1 << 32)

# Fixed value: the pattern of the byte-level pre-tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: printable ones for themselves,
    the others counted upwards from 256."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in own}
    others = [b for b in range(256) if b not in set(own)]
    return letters | {chr(256 + i): b for i, b in enumerate(others)}


_NONE = np.iinfo(np.int64).max


class _PairTable:
    """Rank and result of known pairs: two hash tables without collisions, the second one for keys
    whose place in the first was taken."""

    def __init__(self, keys: np.ndarray, ranks: np.ndarray, made: np.ndarray):
        place = self._place(keys, 44)
        _, first = np.unique(place, return_index=True)
        rest = np.setdiff1d(np.arange(len(keys)), first)
        self.first = self._filled(keys[first], ranks[first], made[first], place[first], 1 << 20)
        order = rest[np.argsort(keys[rest])]
        self.rest = keys[order], ranks[order], made[order]

    @staticmethod
    def _place(keys: np.ndarray, shift: int) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(shift)).astype(np.int64)

    @staticmethod
    def _filled(keys, ranks, made, place, size):
        out = np.full(size, -1, np.int64), np.full(size, _NONE), np.zeros(size, np.int64)
        for table, values in zip(out, (keys, ranks, made), strict=True):
            table[place] = values
        return out

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (or the largest number) and result of each pair."""
        place = self._place(keys, 44)
        table, ranks, made = self.first
        found = table[place] == keys
        rank, result = np.where(found, ranks[place], _NONE), made[place]
        more = np.flatnonzero(~found & (table[place] != -1))
        if len(more) and len(self.rest[0]):
            at = np.minimum(np.searchsorted(self.rest[0], keys[more]), len(self.rest[0]) - 1)
            hit = self.rest[0][at] == keys[more]
            rank[more[hit]], result[more[hit]] = self.rest[1][at[hit]], self.rest[2][at[hit]]
        return rank, result


class BytePairs:
    """Merge table of a vocabulary file, as sorted arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        vocabulary, merges = content["model"]["vocab"], content["model"]["merges"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        left = np.fromiter((vocabulary[a] for a, _ in pairs), np.int64, len(pairs))
        right = np.fromiter((vocabulary[b] for _, b in pairs), np.int64, len(pairs))
        made = np.fromiter((vocabulary[a + b] for a, b in pairs), np.int64, len(pairs))
        keys = left * _PAIR_BASE + right
        self.table = _PairTable(keys, np.arange(len(pairs)), made)
        self.of_byte = np.zeros(256, np.int64)
        for letter, byte in _byte_letters().items():
            self.of_byte[byte] = vocabulary[letter]
        self.special = [t["content"] for t in content["added_tokens"]]
        self.pattern = regex.compile(PATTERN)
        self.specials = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None

    def pre_tokens(self, texts: list[str]) -> list[tuple[list[str], int]]:
        """Per text: its pre-tokens, and how many special tokens stand in it."""
        find = self.pattern.findall
        joined = "".join(texts)
        if not any(s in joined for s in self.special):
            return [(find(t), 0) for t in texts]
        parts = [self.specials.split(t) for t in texts]
        return [([t for part in one for t in find(part)], len(one) - 1) for one in parts]

    def count(self, words: list[bytes]) -> np.ndarray:
        """Symbols left of every word after all merges."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        counts = lengths.copy()
        symbols = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), lengths)
        # of each symbol: rank and result of the pair that it begins within its word
        ranks, made = np.full(len(symbols), _NONE), np.zeros(len(symbols), np.int64)
        stale = np.arange(len(symbols) - 1)
        while len(symbols) > 1:
            stale = stale[owner[stale] == owner[stale + 1]]
            ranks[stale], made[stale] = self.table.look_up(symbols[stale] * _PAIR_BASE + symbols[stale + 1])
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.minimum.reduceat(ranks, first)
            mine = np.repeat(lowest, np.diff(np.r_[first, len(symbols)]))
            begins = np.flatnonzero((ranks == mine) & (mine != _NONE))
            if not len(begins):
                break
            # in a run of overlapping pairs (aaa), every second one from the left
            number = np.arange(len(begins))
            run_start = np.maximum.accumulate(np.where(np.r_[True, np.diff(begins) != 1], number, 0))
            begins = begins[(number - run_start) % 2 == 0]
            counts -= np.bincount(owner[begins], minlength=len(counts))
            symbols[begins] = made[begins]
            ranks[begins] = _NONE
            changed = np.zeros(len(symbols), bool)  # pairs that a merged symbol begins or ends
            changed[begins] = True
            before = begins[begins > 0] - 1
            keep = mine != _NONE  # finished words leave
            keep[begins + 1] = False
            merged_away = ~keep[before]  # the symbol before was itself merged into the one before it
            before = before - merged_away * (before > 0)
            ranks[before] = np.where(owner[before] == owner[np.minimum(before + 1, len(owner) - 1)], _NONE, ranks[before])
            changed[before] = True
            symbols, owner, ranks, made, changed = (x[keep] for x in (symbols, owner, ranks, made, changed))
            stale = np.flatnonzero(changed[:-1]) if len(symbols) > 1 else np.zeros(0, np.int64)
            ends = np.flatnonzero(np.r_[owner[1:] != owner[:-1], True]) if len(symbols) else np.zeros(0, np.int64)
            ranks[ends] = _NONE
        return counts


def count_pieces(table: BytePairs, texts: list[str]) -> list[int]:
    """Tokens of each piece of text."""
    split = table.pre_tokens(texts)
    words = list({w for found, _ in split for w in found})
    known = dict(zip(words, table.count([w.encode("utf-8") for w in words]).tolist(), strict=True))
    return [special + sum(map(known.__getitem__, found)) for found, special in split]


def count_following(table: BytePairs, parts: list[str]) -> list[int]:
    """Tokens of each piece that follows another (see ``spelled``).

    Such pieces begin with white space and hold no other, so their pre-tokens are found in one joined text,
    and a new piece begins wherever a pre-token begins with white space. Pieces of white space only, and those
    with a special string, are counted one by one.
    """
    alone = [i for i, p in enumerate(parts) if not p or p == "\n"]
    if any(s in "\x00".join(parts) for s in table.special):
        alone += [i for i, p in enumerate(parts) if any(s in p for s in table.special)]
    apart = set(alone)
    rest = [i for i in range(len(parts)) if i not in apart]
    out = np.zeros(len(parts), np.int64)
    if rest:
        found = pa.array(table.pattern.findall("".join([spelled(parts[i]) for i in rest])), pa.large_string())
        coded = found.dictionary_encode()
        counts = table.count(coded.dictionary.cast(pa.large_binary()).to_pylist())[coded.indices.to_numpy()]
        heads = pc.utf8_slice_codeunits(found, 0, 1)
        begins = np.flatnonzero(pc.is_in(heads, pa.array([" ", "\n"], pa.large_string())).to_numpy(zero_copy_only=False))
        out[rest] = np.add.reduceat(counts, begins)
    if alone:
        out[alone] = count_pieces(table, [spelled(parts[i]) for i in alone])
    return out.tolist()


def batch_counts(table: BytePairs, known: dict[str, int], texts: list[str]) -> list[int]:
    """Tokens of each text; ``known`` remembers the pieces that follow a space. A piece is looked up once per
    batch, however often it stands there."""
    pieces = Pieces(texts)
    new = [p for p in pieces.names if p not in known]
    if len(known) + len(new) > CACHE_PIECES:  # what this batch holds is remembered
        used = {p: known[p] for p in pieces.names if p in known}
        known.clear()
        known.update(used)
    first = list(set(pieces.first).union(*pieces.odd.values()))
    starts = dict(zip(first, count_pieces(table, first), strict=True))
    known.update(zip(new, count_following(table, new), strict=True))
    out = np.zeros(len(texts), np.int64)
    if pieces.plain:
        each = np.fromiter(map(known.__getitem__, pieces.names), np.int64, len(pieces.names))[pieces.numbers]
        each[pieces.offsets[:-1]] = list(map(starts.__getitem__, pieces.first))
        out[pieces.plain] = np.add.reduceat(each, pieces.offsets[:-1])
    for i, parts in pieces.odd.items():
        out[i] = sum(map(starts.__getitem__, parts))
    return out.tolist()


def token_counts(
    docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", limit: int = LIMIT
) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit of every whole text.

    Counts are those of the tokenizers library for the file at ``path`` (byte-level BPE), without added
    special tokens; special strings inside a text count as one token. A null text is empty: no tokens.
    Repeated rows and null ids each give their row; an empty table gives none. Further columns are
    ignored. ``path`` is a file on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            table = kept_in_worker(("pairs", path), lambda: BytePairs(path))
            known = kept_in_worker(("counts", path), dict)
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0)
            counts: list[int] = []
            for texts in text_slices(batch.column(1), _SLICE_BYTES):
                counts += batch_counts(table, known, texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    sizes.cast(pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array([c > limit for c in counts], pa.bool_()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text).mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean"
    )
