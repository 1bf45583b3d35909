"""Mixing sources to target weights by Pfair scheduling.

Time is cut into slots, and a slot carries one block of documents of one source. Block j of a source
with weight w may not run before its release, floor(j / w), and must run before its deadline,
ceil((j + 1) / w). The earliest deadline among released blocks goes first; as the weights sum to one,
every block meets its window, so after t slots a source has had more than t * w - 1 and fewer than
t * w + 1 blocks.

Weights are kept exactly, as whole numbers over their sum, so windows never drift from the targets. One
pass over the blocks that the sources really have gives their slots: a row per block of 64 documents, made
from a row per source.
"""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F, types as T

from lectern.llm.common import ranked, release_memory
from lectern.operators.rows import sized
from lectern.session import shared_dir, stage

PERIOD = 10_000
BLOCK_DOCUMENTS = 64

# Sources for which ``size_weights`` gives a weight.
OWN_WEIGHTS = 1_000
# Weights go with the documents of a source to this power: 1 keeps their shares, 0 makes them equal.
EXPONENT = 0.5

_PLAN = "_stream string, _block long, release long, deadline long, slot long"
_PLAN_ROWS = 10_000


def whole_parts(weights: list[float], period: int = PERIOD) -> list[int]:
    """Whole numbers in proportion to the weights, at least one each, whose sum is the period."""
    if not weights or len(weights) > period or min(weights) <= 0:
        raise ValueError(f"between one and {period} positive weights are needed")
    total = sum(weights)
    exact = [w / total * (period - len(weights)) for w in weights]
    parts = [1 + int(x) for x in exact]
    rest = sorted(range(len(weights)), key=lambda i: (int(exact[i]) - exact[i], i))
    for i in rest[: period - sum(parts)]:
        parts[i] += 1
    return parts


def windows(parts: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(stream, block, release, deadline, slot) of every block of one period, in slot order."""
    period = sum(parts)
    waiting = [(0, s, 0) for s in range(len(parts))]  # release, stream, block
    ready: list[tuple[int, int, int, int]] = []  # deadline, stream, block, release
    heapq.heapify(waiting)
    out = []
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            release, s, block = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(block + 1) * period // parts[s]), s, block, release))
        deadline, s, block, release = heapq.heappop(ready)
        out.append((s, block, release, deadline, slot))
        if block + 1 < parts[s]:
            heapq.heappush(waiting, ((block + 1) * period // parts[s], s, block + 1))
    return out


def exact_parts(weights: list[float]) -> list[int]:
    """Whole numbers in exactly the proportion of the weights."""
    if not weights or min(weights) <= 0:
        raise ValueError("positive weights are needed")
    exact = [Fraction(w) for w in weights]
    common = max(f.denominator for f in exact)  # powers of two
    return [f.numerator * (common // f.denominator) for f in exact]


def schedule(parts: list[int], blocks: list[int]) -> Iterator[tuple[int, int, int, int, int]]:
    """(stream, block, release, deadline, slot) of the first so many blocks of every stream, in slot order.

    Behind its last block a stream leaves one more slot empty; from then on its share is nobody's, and
    a slot is empty if no block is released.
    """
    period = sum(parts)
    waiting = [(0, s, 0) for s in range(len(parts))]  # release, stream, block
    ready: list[tuple[int, int, int, int]] = []  # deadline, stream, block, release
    heapq.heapify(waiting)
    slot = 0
    while waiting or ready:
        if not ready:
            slot = max(slot, waiting[0][0])
        while waiting and waiting[0][0] <= slot:
            release, s, block = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(block + 1) * period // parts[s]), s, block, release))
        deadline, s, block, release = heapq.heappop(ready)
        if block < blocks[s]:
            yield s, block, release, deadline, slot
            heapq.heappush(waiting, ((block + 1) * period // parts[s], s, block + 1))
        slot += 1


def size_weights(
    docs: DataFrame, source: str = "source", exponent: float = EXPONENT, at_most: int = OWN_WEIGHTS
) -> tuple[dict[str, float], float | None]:
    """Target weights from the number of documents per source, for the largest sources, and one for
    all the others together (None if there are no others). Counted over all documents."""
    counts = stage(docs.groupBy(F.col(source).alias("s")).agg(F.count("*").alias("n")), "mix-counts")
    own = counts.where(F.col("s").isNotNull()).orderBy(F.desc("n"), "s").limit(at_most).collect()
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rest = total - sum(r["n"] for r in own)
    return {r["s"]: r["n"] ** exponent for r in own}, (rest**exponent if rest else None)


def mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    rest_weight: float | None = None,
    id_col: str = "doc_id",
    source: str = "source",
    block_documents: int = BLOCK_DOCUMENTS,
    period: int | None = None,
) -> DataFrame:
    """One row per document: doc_id, source, block, release, deadline, slot, place; the mix is their
    order by slot and place.

    The documents of a source are cut into blocks in the order of a hash of their ids. Without weights,
    every source, null included, has one of its own, its documents to the power of ``EXPONENT``. With
    weights, sources without one, and null, form one stream with ``rest_weight`` (by default the
    smallest weight given). No document is dropped or repeated:
    the others keep their windows when a source has no blocks left, and slots without a block stay empty.

    Weights hold exactly. With ``period`` they are rounded to whole parts of it first (``whole_parts``).

    Rows that repeat id and source are one document. Null ids are one document per source. An empty
    table gives no rows. Further columns are ignored.
    """
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(source).alias("source")).distinct()
    if weights is None:
        chosen = chosen.withColumn("stream", F.col("source"))
    else:
        known = _weights(docs, weights)
        chosen = chosen.join(known, F.col("source") == F.col("_name"), "left").select("doc_id", "source", F.col("_name").alias("stream"))
    streamed = chosen.withColumn("_order", F.xxhash64("doc_id", "source"))
    numbered = ranked(streamed, ["stream"], ["_order", "doc_id", "source"], "_rank", "mix-ranks")
    counts = numbered.groupBy("stream").agg(F.count("*").alias("n"))
    if weights is None:
        streams = counts.select("stream", F.pow("n", F.lit(EXPONENT)).alias("weight"), "n")
    else:
        given = known.select(F.col("_name").alias("stream"), F.col("_weight").alias("weight"))
        if rest_weight is None:
            rest_weight = min(weights.values(), default=1.0)
        rest = docs.sparkSession.createDataFrame([(None, float(rest_weight))], given.schema)
        same = F.col("stream").eqNullSafe(F.col("_stream"))
        streams = given.unionByName(rest).join(counts.withColumnRenamed("stream", "_stream"), same, "left")
        streams = streams.where("stream IS NOT NULL OR n > 0")  # without documents the rest takes no share
        streams = streams.select("stream", "weight", F.coalesce("n", F.lit(0)).alias("n"))
    plan = _plan(stage(streams, "mix-streams"), block_documents, period)
    placed = numbered.withColumn("block", F.floor(F.col("_rank") / block_documents))
    placed = placed.withColumn("place", F.col("_rank") % block_documents)
    same = placed.stream.eqNullSafe(plan._stream) & (placed.block == plan._block)
    return placed.join(sized(plan), same).select("doc_id", "source", "block", "release", "deadline", "slot", "place")


def _weights(docs: DataFrame, weights: dict[str, float]) -> DataFrame:
    pairs = [(n, float(w)) for n, w in weights.items()]
    return F.broadcast(docs.sparkSession.createDataFrame(pairs, "_name string, _weight double"))  # one row per weight given


def _plan(streams: DataFrame, block_documents: int, period: int | None) -> DataFrame:
    """_stream, _block, release, deadline, slot: one row per block, made by one task from one row per
    stream (stream, weight, n documents)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
        rows.sort(key=lambda r: (r[0] is None, r[0] or ""))
        if not rows:
            return
        weights = [w for _, w, _ in rows]
        parts = exact_parts(weights) if period is None else whole_parts(weights, period)
        held: list[tuple] = []
        for s, *rest in schedule(parts, [-(-n // block_documents) for *_, n in rows]):
            held.append((rows[s][0], *rest))
            if len(held) == _PLAN_ROWS:
                yield _plan_batch(held)
                held = []
        if held:
            yield _plan_batch(held)

    made = streams.coalesce(1).mapInArrow(run, _PLAN)
    return stage(made, "mix-plan")


def _plan_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), *[pa.int64()] * 4]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=["_stream", "_block", "release", "deadline", "slot"])


# Places that a task holds at a time of the file it reads.
_PLACES = 1 << 18


def _own_name(name: str, taken: list[str]) -> str:
    """A column name that the table does not have."""
    while name in taken:
        name = f"_{name}"
    return name


def _located(docs: DataFrame, file: str, row: str) -> DataFrame:
    """The rows with the file they are read from, by a hash of its name, and their number in it. A table that
    is no plain scan of files is stored first."""
    place = [F.xxhash64("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row)]
    try:
        return docs.select("*", *place)
    except AnalysisException:
        return stage(docs, "mix-rows").select("*", *place)


def _with_places(located: DataFrame, folder: str, file: str, row: str) -> tuple[DataFrame, list[str]]:
    """The rows with part, slot and place, and the names of these columns, as stored for them below ``folder``, a folder per file
    sorted by row. A task reads the places of its own rows only, as it comes to them."""
    columns = [c for c in located.columns if c not in (file, row)]
    kept = [located.columns.index(c) for c in columns]
    at_file, at_row = located.columns.index(file), located.columns.index(row)
    names = [_own_name(c, columns) for c in ("part", "slot", "place")]
    fields = [located.schema[c] for c in columns] + [T.StructField(n, T.LongType()) for n in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        key, first, held = None, 0, None

        def places(name: int, a: int, b: int) -> pa.Table:
            """The stored places of rows a to b - 1 of a file."""
            nonlocal key, first, held
            if key != name or a < first or b > first + _PLACES:
                wanted = (ds.field("row") >= a) & (ds.field("row") < a + _PLACES)
                table = ds.dataset(f"{base}/file={name}", filesystem=store, format="parquet").to_table(filter=wanted)
                key, first, held = name, a, table.sort_by("row")
            rows = held.column("row").to_numpy()
            return held.slice(int(np.searchsorted(rows, a)), int(np.searchsorted(rows, b) - np.searchsorted(rows, a)))

        for batch in batches:
            if not batch.num_rows:
                continue
            files, rows = batch.column(at_file).to_numpy(), batch.column(at_row).to_numpy()
            cuts = np.r_[0, np.flatnonzero((np.diff(files) != 0) | (np.diff(rows) <= 0)) + 1, len(files)]
            for x, y in zip(cuts, cuts[1:], strict=False):
                for u in range(x, y, _PLACES // 4):
                    v = min(u + _PLACES // 4, y)
                    while rows[v - 1] - rows[u] >= _PLACES:  # rows left out in between
                        v = u + (v - u) // 2
                    found = places(int(files[u]), int(rows[u]), int(rows[v - 1]) + 1)
                    at = np.searchsorted(found.column("row").to_numpy(), rows[u:v])
                    more = [pa.array(found.column(c).to_numpy()[at]) for c in ("part", "slot", "place")]
                    yield pa.RecordBatch.from_arrays(
                        [*[batch.column(i).slice(u, v - u) for i in kept], *more], names=[*columns, *names]
                    )
        held = None
        release_memory()

    return located.mapInArrow(run, T.StructType(fields)), names


def in_mix_order(docs: DataFrame, id_col: str = "doc_id", source: str = "source", **options) -> DataFrame:
    """All rows with their columns, partitioned by slot and sorted so that files written from them follow
    the mix. Rows of one document stay together.

    Texts are shuffled once. The mix is made of narrow rows, which are stored by the file and row that
    each document is read from; the scan of the documents then picks up their places file by file.
    Slots are dealt evenly to the partitions, so none holds more than its share of the blocks.
    """
    spark = docs.sparkSession
    file, row = _own_name("file", docs.columns), _own_name("row", docs.columns)
    located = _located(docs, file, row)
    order = stage(mix(docs, id_col=id_col, source=source, **options), "mix-order")
    last = order.agg(F.max("slot")).first()[0]
    if last is None:
        return docs
    partitions = max(1, located.rdd.getNumPartitions())
    narrow = located.select(F.col(id_col).alias("_id"), F.col(source).alias("_source"), F.col(file).alias("file"), F.col(row).alias("row"))
    same = narrow["_id"].eqNullSafe(order["doc_id"]) & narrow["_source"].eqNullSafe(order["source"])
    part = F.floor(F.col("slot") * partitions / (last + 1)).cast("long")
    placed = narrow.join(order, same).select("file", "row", part.alias("part"), "slot", "place")
    folder = f"{shared_dir(spark).rstrip('/')}/mix-places-{uuid.uuid4().hex}"
    placed.repartitionByRange("file", "row").sortWithinPartitions("file", "row").write.partitionBy("file").parquet(folder)
    whole, (part, slot, place) = _with_places(located, folder, file, row)
    moved = whole.repartitionById(partitions, F.col(part).cast("int")).sortWithinPartitions(slot, place)
    return moved.select(*docs.columns)
