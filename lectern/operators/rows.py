"""Small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

# Largest table that is broadcast, in rows and in bytes of its values. Every broadcast hint in the
# package is given only after a check against these bounds; beyond them the same join is a shuffle join.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 32 << 20


def explode_structs(df: DataFrame, carry: list[str], array: Column, fields: list[str]) -> DataFrame:
    """One row per struct of an array, its fields as columns.

    The outer form plus a filter keeps the optimizer from evaluating the array a second time in a
    filter below the generator.
    """
    return (
        df.select(*carry, F.explode_outer(array).alias("_item"))
        .where("_item IS NOT NULL")
        .select(*carry, *[F.col(f"_item.{field}").alias(field) for field in fields])
    )


def fits(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether a table has at most so many rows, and so many bytes of values. Meant for staged tables."""
    fixed = sum(not isinstance(f.dataType, (T.StringType, T.BinaryType, T.ArrayType)) for f in df.schema) * 8
    width = F.lit(fixed).cast("long")
    for field in df.schema:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, T.ArrayType):
            # other than numbers, an element is counted by its text
            text = F.octet_length(F.to_json(field.name)) if not isinstance(field.dataType.elementType, T.NumericType) else F.size(field.name) * 8
            width = width + F.coalesce(text, F.lit(0))
    found = df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("size")).first()
    return found["rows"] <= rows and found["size"] <= size


def sized(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The table with a broadcast hint if it is within the bounds, else as it is."""
    return F.broadcast(df) if fits(df, rows) else df


def top_k(df: DataFrame, group: str | list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows per group with their rank from 1.

    Spark limits every group to ``k`` rows within each task before it shuffles, so a group that holds
    a large share of all rows sends at most ``k`` rows per task.
    """
    window = Window.partitionBy(*([group] if isinstance(group, str) else group)).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)
