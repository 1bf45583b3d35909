"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from lectern.operators.rows import sized
from lectern.session import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_ROW_BITS = 33  # Spark's increasing ids: task number above, row number within the task below


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is.

    For a text of ASCII characters only that is what ``lower`` does, and much faster.
    """
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def ranked(df: DataFrame, group: list[str], order: list[str], rank: str, name: str) -> DataFrame:
    """Number the rows of every group 0, 1, 2, ... in the given order; one group may hold most rows.

    The rows are range-partitioned by group and order, so a large group lies in many tasks, and
    written once so that the borders stay. A row's rank is its place within its task plus the rows
    that earlier tasks hold of its group; those counts are one row per task and group. Rows equal in
    group and order are numbered in any order among themselves.
    """
    keys = [*group, *order]
    ordered = stage(
        df.repartitionByRange(*[F.col(c) for c in keys])
        .sortWithinPartitions(*keys)
        .withColumn("_slot", F.monotonically_increasing_id()),
        name,
    )
    task = F.shiftright("_slot", _ROW_BITS).alias("_task")
    counts = ordered.groupBy(*group, task).agg(F.count("*").alias("_rows"), F.min("_slot").alias("_first"))
    before = Window.partitionBy(*group).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(
        counts.select(
            *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)],
            "_task",
            (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        ),
        f"{name}-offsets",
    )
    same = [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(group)]
    matches = F.shiftright("_slot", _ROW_BITS) == F.col("_task")
    for condition in same:
        matches = matches & condition
    return ordered.join(sized(offsets), matches).select(*df.columns, (F.col("_slot") + F.col("_shift")).alias(rank))


def map_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str
) -> DataFrame:
    """Apply a function to every Arrow batch. Batches without a result are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (result := function(batch)) is not None:
                yield result
        release_memory()

    return df.mapInArrow(run, schema)


# Rows that the JVM hands to a worker at a time while texts are read: with Spark's 10,000, a batch of texts is held
# several times over on both sides. Results do not depend on it.
BATCH_SETTING, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1_000

_KEPT: dict = {}


def kept_in_worker(key: tuple, make: Callable[[], object]):
    """An object that a Python worker keeps from task to task: a table read from a file, a bounded cache."""
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


def forget_kept() -> None:
    """Drop what other operators have kept in this worker, before one that needs the room; they make it anew."""
    _KEPT.clear()


def release_memory() -> None:
    """Give back what batches that are gone have left in the pools of Arrow and, where it can be asked, of the C library.
    A worker lives on after its task, beside those of other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def text_slices(column: pa.Array, limit: int) -> Iterator[list[str]]:
    """The texts of a batch in runs of about ``limit`` bytes; null as empty."""
    lengths = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    for a, b in slices_by_bytes(lengths, limit):
        yield [t or "" for t in column.slice(a, b - a).to_pylist()]


def slices_by_bytes(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Cut consecutive rows into runs of about ``limit`` bytes; a larger row is a run of its own."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)
