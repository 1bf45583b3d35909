"""Raw file scans, one row per file: path, length, modificationTime, content."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.functions.text import file_type
from lectern.sources.tables import if_stored

# The extensions that are accepted, by the way they are parsed.
TEXT_TYPES = ("txt", "log", "md")
PAGED_TYPES = ("pdf",)
FLAT_TYPES = ("txt", "pdf")

# Spark packs small files into partitions of some thirty; beyond so many partitions, a task reads up to SCAN_PACKED of them.
SCAN_TASKS, SCAN_PACKED = 1_000, 16

# What opening a small file counts for when an ingestion's files are packed into partitions, instead of Spark's 4 MB.
OPEN_COST, OPEN_COST_BYTES = "spark.sql.files.openCostInBytes", str(64 << 10)

# Files that an ingestion lists at a time, if folders allow it: the driver takes about 1 KB for each.
LISTED_FILES = 250_000


def _packed(scan: DataFrame, tasks: int = SCAN_TASKS, packed: int = SCAN_PACKED) -> DataFrame:
    """The scan in fewer tasks where it has very many small ones, without a shuffle: rows stream through a task, so
    it holds no more at a time, and whoever writes the rows leaves fewer files."""
    found = scan.rdd.getNumPartitions()
    return scan.coalesce(max(tasks, math.ceil(found / packed))) if found > tasks else scan


def _glob(extensions: Iterable[str]) -> str:
    """A file-name pattern that matches the extensions in any letter case."""
    spelled = ["".join(f"[{c.lower()}{c.upper()}]" for c in extension) for extension in extensions]
    return "*.{" + ",".join(spelled) + "}"


def parts(spark: SparkSession, path: str, most: int = LISTED_FILES) -> list[list[str]]:
    """The folders below ``path``, in groups of at most ``most`` files, since the driver holds the list of a scan's files.

    Only folders without files of their own are divided; any other is in a group as a whole, however many files it has,
    and so is a path that is no folder.
    """
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def units(folder, files: int | None) -> Iterator[tuple[str, int]]:
        below = store.listStatus(folder) if files is None or files > most else []
        below = sorted((f for f in below if not _hidden(f.getPath().getName())), key=lambda f: f.getPath().getName())
        if not below or not all(f.isDirectory() for f in below):
            yield folder.toString(), files or 0
            return
        for child in below:
            yield from units(child.getPath(), store.getContentSummary(child.getPath()).getFileCount())

    if not store.exists(at) or not store.getFileStatus(at).isDirectory():
        return [[path]]
    groups, held = [], 0
    for folder, files in units(at, None):
        if not groups or held + files > most:
            groups.append([])
            held = 0
        groups[-1].append(folder)
        held += files
    return groups if len(groups) > 1 else [[path]]


def _hidden(name: str) -> bool:
    """Whether a file scan leaves a folder out."""
    return name.startswith(".") or name.startswith("_") and "=" not in name


def scan_kinds(spark: SparkSession, path: str | list[str], *kinds: Iterable[str]) -> list[DataFrame]:
    """A scan like ``scan_corpus`` for each group of extensions. The folder is listed once for all of them, and
    which files belong to a scan is known from their names when it is planned, so it opens no others."""
    listed = _listing(spark, path, [extension for kind in kinds for extension in kind])
    name = F.lower("_metadata.file_name")
    return [_rows(listed.where(F.substring_index(name, ".", -1).isin(*kind))) for kind in kinds]


def scan_corpus(
    spark: SparkSession,
    path: str,
    extensions: Iterable[str] = TEXT_TYPES + PAGED_TYPES,
    recursive: bool = True,
) -> DataFrame:
    """Files below ``path`` with one of the extensions.

    The name filter is applied while listing, so other files are never opened. File names that start
    with ``_`` or ``.`` are hidden, as in every Spark file scan.
    """
    return _rows(_packed(_listing(spark, path, extensions, recursive)))


def _listing(spark: SparkSession, path: str | list[str], extensions: Iterable[str], recursive: bool = True) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", str(recursive).lower())
        .option("pathGlobFilter", _glob(extensions))
        .load(path)
    )


def _rows(scan: DataFrame) -> DataFrame:
    return scan.select(
        F.col("path").alias("source_path"),
        file_type("path").alias("file_type"),
        F.col("length").alias("file_size_bytes"),
        "content",
    )


def scan_flat(spark: SparkSession, path: str, extensions: Iterable[str] = FLAT_TYPES) -> DataFrame:
    """Text and paged files directly in ``path``, not in its sub-folders, whatever they are called: a scan of
    the folder itself would take names such as ``lang=en`` for partitions and read them too."""
    names = f"{path.rstrip('/')}/[^_.]{_glob(extensions)}"
    found = if_stored(lambda: scan_corpus(spark, names, extensions, recursive=False))
    return scan_corpus(spark, path, extensions).where(F.lit(False)) if found is None else found
