"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"

# Options of tables that hold texts or ids: two thirds of the bytes that Spark's default leaves.
COMPACT = {"compression": "zstd"}


def local_session(
    cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g", warehouse: str | None = None
) -> SparkSession:
    """A session on this machine, for tests and measurements."""
    builder = SparkSession.builder if warehouse is None else SparkSession.builder.config(WAREHOUSE_DIR, warehouse)
    return (
        builder.master(f"local[{cpus}]")
        .appName("lectern")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor reaches: the one that ``spark.checkpoint.dir`` names, else one
    below the warehouse, which all of them share too. No setting is changed: core ones cannot be."""
    return spark.conf.get(CHECKPOINT_DIR, None) or f"{spark.conf.get(WAREHOUSE_DIR).rstrip('/')}/lectern-stage"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for the jobs that run inside; it is put back afterwards."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stage(df: DataFrame, name: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage, gives later plans the exact size, and survives the loss of any executor.
    """
    return stage_parts(df.sparkSession, [df], name, options)


def stage_parts(spark: SparkSession, parts: Iterable[DataFrame], name: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """The same for a table that comes in parts, written one after the other; there is one at least."""
    path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
    for df in parts:
        df.write.options(**(options or {})).mode("append").parquet(path)
        schema = df.schema
    return spark.read.schema(schema).parquet(path)
