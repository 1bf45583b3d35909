"""Packing into batches of equal padded length.

Sequences go into length buckets, each padded to its boundary. Dynamic programming over the histogram
of all lengths chooses the boundaries with the least padding; inside a bucket, batches hold as many
sequences as a token budget allows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lectern.llm.common import BATCH_ROWS, BATCH_SETTING, kept_in_worker, ranked, release_memory, text_slices
from lectern.llm.token_counts import BytePairs, batch_counts
from lectern.session import setting, stage

MAX_TOKENS = 2048
BUCKETS = 8
BATCH_TOKENS = 65_536

_SLICE_BYTES = 2 << 20


def word_tokens(text: Column) -> Column:
    """Words between white space, and one token for the end of the document."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")) + 1


def counted(
    docs: DataFrame, path: str, order: list[Column] | None = None, id_col: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, list[Column]]:
    """A stored table of id and ``n_tokens``, the tokens of the vocabulary file at ``path`` and one for the
    end of the document, with the columns of the order; and that order. For ``pack`` with
    ``tokens=F.col("n_tokens")``. Null counts as empty."""
    if order is None:
        order = [F.xxhash64(id_col), F.col(id_col)]
    names = [f"__order{i}" for i in range(len(order))]
    rows = docs.select(F.col(text).alias("__text"), F.col(id_col), *[o.alias(n) for o, n in zip(order, names, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        for batch in batches:
            if not batch.num_rows:
                continue
            table = kept_in_worker(("pairs", path), lambda: BytePairs(path))
            known = kept_in_worker(("counts", path), dict)
            counts: list[int] = []
            for texts in text_slices(batch.column(0), _SLICE_BYTES):
                counts += batch_counts(table, known, texts)
            lengths = pa.array([c + 1 for c in counts], pa.int64())
            yield pa.RecordBatch.from_arrays([lengths, *batch.columns[1:]], names=["n_tokens", *batch.schema.names[1:]])
        release_memory()

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    with setting(docs.sparkSession, BATCH_SETTING, str(BATCH_ROWS)):
        out = stage(rows.mapInArrow(run, f"n_tokens long, {kinds}"), "pack-tokens")
    return out, [F.col(n) for n in names]


def pack_tokens(
    docs: DataFrame, path: str, order: list[Column] | None = None, id_col: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """``pack`` by the tokens of the vocabulary file at ``path``, a file on every executor."""
    rows, order = counted(docs, path, order, id_col, text)
    return pack(rows, id_col, tokens=F.col("n_tokens"), order=order, **options)


def best_boundaries(lengths: list[int], counts: list[int], buckets: int = BUCKETS) -> tuple[list[int], int]:
    """Boundaries, the largest length last, and the padding they leave; ``lengths`` ascending.

    best(k, j) is the least padding of the j smallest lengths in k buckets; the last bucket takes the
    lengths i..j and pads them to length j. Of equal choices the one with fewer lengths before it.
    """
    size = np.array(lengths, np.int64)
    n = np.r_[0, np.cumsum(counts)]
    total = np.r_[0, np.cumsum(size * np.array(counts, np.int64))]
    m = len(size)
    if not m:
        return [], 0
    i = np.arange(m)[:, None]
    j = np.arange(1, m + 1)[None, :]
    padding = size[None, :] * (n[j] - n[i]) - (total[j] - total[i])
    never = np.iinfo(np.int64).max // 2
    padding = np.where(i < j, padding, never)  # lengths i..j-1 in one bucket
    best = np.r_[0, np.full(m, never)]
    choices = []
    for _ in range(min(buckets, m)):
        cost = np.minimum(best[:-1, None] + padding, never)
        choice = cost.argmin(axis=0)
        choices.append(choice)
        best = np.r_[never, cost[choice, np.arange(m)]]
    at, out = m, []
    for choice in reversed(choices):
        out.append(int(size[at - 1]))
        at = int(choice[at - 1])
    return out[::-1], int(best[m])


def sequences(
    docs: DataFrame, tokens: Column, order: list[Column], id_col: str = "doc_id", max_tokens: int = MAX_TOKENS
) -> DataFrame:
    """doc_id, piece, start, n_tokens: documents cut into pieces of at most ``max_tokens``."""
    names = [f"_order{i}" for i in range(len(order))]
    last = F.floor((F.col("_n") - 1) / max_tokens).cast("int")
    return (
        docs.select(F.col(id_col).alias("doc_id"), tokens.cast("long").alias("_n"), *[o.alias(n) for o, n in zip(order, names, strict=True)])
        .where("_n > 0")
        .select("*", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
        .select(
            "doc_id",
            "piece",
            (F.col("piece").cast("long") * max_tokens).alias("start"),
            F.least(F.col("_n") - F.col("piece").cast("long") * max_tokens, F.lit(max_tokens)).cast("int").alias("n_tokens"),
            *names,
        )
    )


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    tokens: Column | None = None,
    order: list[Column] | None = None,
    max_tokens: int = MAX_TOKENS,
    buckets: int = BUCKETS,
    batch_tokens: int = BATCH_TOKENS,
) -> DataFrame:
    """One row per sequence: doc_id, piece, start, n_tokens, bucket, padded_length, batch, place.

    A document longer than ``max_tokens`` gives several pieces, so no token is lost. The histogram has
    at most ``max_tokens`` lengths, counted over all sequences. A batch (numbered within its bucket)
    holds ``batch_tokens // padded_length`` sequences, one at least; only the last of a bucket may hold
    fewer. Sequences are batched in the given order, by default that of a hash of the ids.

    ``tokens`` is the length of a row, by default its words and an end mark. A null text is empty and has
    the end mark only. Rows that repeat an id are packed each. An empty table gives no rows.
    """
    if tokens is None:
        tokens = word_tokens(F.coalesce(F.col(text), F.lit("")))
    if order is None:
        order = [F.xxhash64(id_col), F.col(id_col)]
    cut = stage(sequences(docs, tokens, order, id_col, max_tokens), "pack-sequences")
    histogram = cut.groupBy("n_tokens").agg(F.count("*").alias("n")).orderBy("n_tokens").collect()
    boundaries, _ = best_boundaries([r["n_tokens"] for r in histogram], [r["n"] for r in histogram], buckets)
    edges = F.array(*[F.lit(b) for b in boundaries]).cast("array<int>")
    bucket = F.size(F.filter(edges, lambda b: b < F.col("n_tokens")))
    placed = cut.withColumn("bucket", bucket)
    names = [c for c in placed.columns if c.startswith("_order")]
    numbered = ranked(placed, ["bucket"], [*names, "piece"], "_rank", "pack-ranks")
    padded = F.element_at(edges, F.col("bucket") + 1)
    room = F.greatest(F.lit(1), F.floor(F.lit(batch_tokens) / F.col("padded_length")))
    return numbered.withColumn("padded_length", padded).select(
        "doc_id",
        "piece",
        "start",
        "n_tokens",
        "bucket",
        "padded_length",
        F.floor(F.col("_rank") / room).alias("batch"),
        (F.col("_rank") % room).alias("place"),
    )


def written_order() -> list[Column]:
    """The order of the rows in the files that a table is read from."""
    return [F.input_file_name(), F.input_file_block_start(), F.monotonically_increasing_id()]
