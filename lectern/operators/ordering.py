"""Total order over a whole table: dense positions, pages, write batches."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window, functions as F

from lectern.operators.rows import BROADCAST_ROWS
from lectern.session import stage

# Fixed value: rows per write batch.
BATCH_ROWS = 10_000

_ROW_BITS = 33  # Spark's increasing ids: task number above, row number within the task below


def dense_index(
    df: DataFrame, key: str, position: str = "position", name: str = "ordered", options: Mapping[str, str] | None = None
) -> DataFrame:
    """Number the rows 0, 1, 2, ... in the order of a unique key.

    Range-partitioned and sorted in parallel, then written once so that the partition borders cannot
    change between the two passes; the only table that is gathered has one row per partition.
    """
    ordered = stage(
        df.repartitionByRange(F.col(key))
        .sortWithinPartitions(key)
        .withColumn("_slot", F.monotonically_increasing_id()),
        name,
        options,
    )
    task = F.shiftright("_slot", _ROW_BITS)
    row = F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ordered.groupBy(task.alias("_task"))
        .agg(F.count("*").alias("_rows"))
        .select("_task", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        ordered.withColumn("_task", task)
        .withColumn("_row", row)
        .join(F.broadcast(offsets), "_task")
        .withColumn(position, F.col("_offset") + F.col("_row"))
        .drop("_slot", "_task", "_row", "_offset")
    )


def write_batches(df: DataFrame, key: str, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """The rows with the number of the write batch they belong to, in key order."""
    return dense_index(df, key, "_position", "batches").select(
        *df.columns, F.floor(F.col("_position") / batch_rows).alias("batch")
    )


def page_of_rows(df: DataFrame, key: str, offset: int, limit: int) -> DataFrame:
    """Rows ``offset`` to ``offset + limit - 1`` in key order, at any depth.

    Only the keys are ordered; the rows of the page are then picked from the table by key.
    """
    if offset < 0 or limit < 0:
        raise ValueError("offset and limit must not be negative")
    numbered = dense_index(df.select(key), key, "_position", "pages")
    page = numbered.where((F.col("_position") >= offset) & (F.col("_position") < offset + limit))
    keys = F.broadcast(page.select(key)) if limit <= BROADCAST_ROWS else page.select(key)
    return df.join(keys, key, "left_semi").select(*df.columns)
