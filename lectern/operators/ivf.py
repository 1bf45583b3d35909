"""Inverted lists: vectors grouped by their nearest centroid, queries look into a few lists only."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lectern.operators.nearest import (
    BROADCAST_BYTES,
    _block_nearest,
    _small_side,
    nearest,
    nearest_in_lists,
    ranked,
)
from lectern.operators.rows import sized
from lectern.session import stage

# Lists per square root of the vectors, vectors per list at least, lists searched per query.
LISTS_PER_SQRT = 2
VECTORS_PER_LIST = 39
PROBES = 10
# Rounds of k-means.
TRAINING_ROUNDS = 4
# Vectors per list from which an index trains its centroids.
TRAINING_VECTORS = 64

# Probed lists are named in the scan's filter up to this number, so that other row groups are skipped.
FILTERED_LISTS = 1_000


def list_count(vectors: int) -> int:
    """Number of lists: about twice the square root, but enough vectors for each; at least 1."""
    return max(1, min(int(LISTS_PER_SQRT * math.sqrt(vectors)), vectors // VECTORS_PER_LIST))


def probe_count(lists: int) -> int:
    return min(PROBES, lists)


def parameters(vectors: DataFrame) -> DataFrame:
    """One row (total_vectors, nlist, nprobe) for a vector table."""
    total = vectors.agg(F.count("*").alias("total_vectors"))
    by_size = F.floor(LISTS_PER_SQRT * F.sqrt("total_vectors"))
    lists = F.greatest(
        F.lit(1).cast("long"), F.least(by_size, F.floor(F.col("total_vectors") / VECTORS_PER_LIST))
    )
    return total.withColumn("nlist", lists).withColumn("nprobe", F.least(F.lit(PROBES).cast("long"), "nlist"))


def seed_centroids(vectors: DataFrame, lists: int) -> DataFrame:
    """(list_id, centroid): ``lists`` vectors chosen by the hash of their id, numbered in that order.

    A reproducible choice of centroids without training; also the order of the table does not matter.
    """
    chosen = vectors.select(F.md5(F.col("vec_id").cast("string")).alias("_order"), "embedding")
    first = chosen.orderBy("_order").limit(lists)  # at most 2 * sqrt(n) rows
    number = F.row_number().over(Window.orderBy("_order")) - 1
    return first.select(number.alias("list_id"), F.col("embedding").alias("centroid"))


def training_sample(vectors: DataFrame, total: int, lists: int, per_list: int = TRAINING_VECTORS) -> DataFrame:
    """All vectors, if there are at most ``per_list`` for each list; else about so many, chosen by the hash of their id.

    Lists grow with the square root of the vectors, so rounds over all would cost their power of 1.5; over the
    sample they cost in proportion. Every vector is then placed in the list of its nearest centroid.
    """
    parts = total // max(1, per_list * lists)
    return vectors if parts < 2 else vectors.where(F.pmod(F.xxhash64("vec_id"), F.lit(parts)) == 0)


def train_centroids(
    vectors: DataFrame, lists: int, rounds: int = TRAINING_ROUNDS, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """(list_id, centroid) by k-means over all vectors, from the seed centroids, in a fixed number of rounds.

    A round is one pass: every vector goes to its nearest centroid, and a task sums its own vectors per
    list, so that at most a row per list and task is shuffled. A list without vectors keeps its centroid,
    and the centroids stay in tables.
    """
    centroids = stage(seed_centroids(vectors, lists), "centroids")
    for _ in range(rounds):
        placed = with_list(vectors.select("embedding"), centroids, broadcast_bytes=broadcast_bytes)
        moved = centroids.join(_means(placed), "list_id", "left").select(
            "list_id", F.coalesce("mean", F.col("centroid").cast("array<double>")).alias("centroid")
        )
        centroids = stage(moved, "centroids")
    return centroids


def _matrix(column: pa.Array):
    """The vectors of a batch, all of one dimension, as rows of doubles."""
    import numpy as np

    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def with_list(vectors: DataFrame, centroids: DataFrame, *, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The rows with ``list_id``, their nearest centroid (ties by the smaller list), and ``list_distance``, the
    squared distance to it.

    The centroids go to every task if they are within the bound, and the rows stay where they are.
    Beyond it the assignment is found cell by cell and joined to the rows by a key made for them.
    """
    small = _small_side(centroids, "list_id", "centroid", broadcast_bytes)
    if small is None:
        keyed = stage(vectors.withColumn("_key", F.monotonically_increasing_id()), "vectors")
        lists = centroids.select(F.col("list_id").alias("vec_id"), F.col("centroid").alias("embedding"))
        points = keyed.select(F.col("_key").alias("query_id"), F.col("embedding").alias("query_vector"))
        found = nearest(lists, points, 1, few_vectors=True, broadcast_bytes=broadcast_bytes)
        found = found.select(F.col("query_id").alias("_key"), F.col("vec_id").cast("int").alias("list_id"), F.col("distance").alias("list_distance"))
        return keyed.join(found, "_key").drop("_key")
    shared = vectors.sparkSession.sparkContext.broadcast(small)
    kernel = _block_nearest()
    at = vectors.columns.index("embedding")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        ids, matrix = shared.value
        ids = np.array(ids, np.int32)
        for batch in batches:
            if batch.num_rows:
                query_row, list_row, distance = kernel(matrix, _matrix(batch.column(at)), 1)
                order = np.argsort(query_row, kind="stable")
                columns = [pa.array(ids[list_row[order]]), pa.array(distance[order])]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *columns], names=[*batch.schema.names, "list_id", "list_distance"]
                )

    return vectors.mapInArrow(run, f"{fields}, list_id int, list_distance double")


def _means(placed: DataFrame) -> DataFrame:
    """(list_id, mean) of vectors with a list, from one sum per list and task."""
    sums = "list_id int, n long, sums array<double>"

    def by_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        total, count = {}, {}
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix = _matrix(batch.column(0))
            found, group = np.unique(batch.column(1).to_numpy(), return_inverse=True)
            order = np.argsort(group, kind="stable")
            starts = np.searchsorted(group[order], np.arange(len(found)))
            parts = np.add.reduceat(matrix[order], starts, axis=0)
            for name, row, n in zip(found.tolist(), parts, np.bincount(group).tolist(), strict=True):
                total[name] = total.get(name, 0.0) + row
                count[name] = count.get(name, 0) + n
        if total:
            rows = [pa.array(list(total), pa.int32()), pa.array(list(count.values()), pa.int64()), pa.array(list(total.values()), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(rows, names=["list_id", "n", "sums"])

    def over_tasks(rows: pa.Table) -> pa.Table:  # a row per task
        import numpy as np

        parts = np.stack([np.array(v) for v in rows.column("sums").to_pylist()])
        mean = parts.sum(axis=0) / sum(rows.column("n").to_pylist())
        return pa.table({"list_id": rows.column("list_id").slice(0, 1), "mean": pa.array([mean.tolist()], pa.list_(pa.float64()))})

    partial = placed.select("embedding", "list_id").mapInArrow(by_task, sums)
    return partial.groupBy("list_id").applyInArrow(over_tasks, "list_id int, mean array<double>")


def assign(vectors: DataFrame, centroids: DataFrame, **options: int) -> DataFrame:
    """(vec_id, list_id): the nearest centroid of every vector; ties by the smaller list."""
    lists = centroids.select(F.col("list_id").alias("vec_id"), F.col("centroid").alias("embedding"))
    points = vectors.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    found = nearest(lists, points, 1, few_vectors=True, **options)
    return found.select(F.col("query_id").alias("vec_id"), F.col("vec_id").alias("list_id"))


def build_lists(vectors: DataFrame, centroids: DataFrame) -> DataFrame:
    """(list_id, vec_id, embedding) of all vectors."""
    return with_list(vectors.select("vec_id", "embedding"), centroids).select("list_id", "vec_id", "embedding")


def list_extents(placed: DataFrame) -> DataFrame:
    """(list_id, size, near, far): the vectors of each list, and their smallest and largest distance to its
    centroid, from rows with ``list_distance``."""
    distance = F.sqrt("list_distance")
    return placed.groupBy("list_id").agg(
        F.count("*").alias("size"), F.min(distance).alias("near"), F.max(distance).alias("far")
    )


def probes(queries: DataFrame, centroids: DataFrame, nprobe: int, ranks: bool = False) -> DataFrame:
    """(query_id, list_id): the lists every query looks into, with their ``rank`` if asked for."""
    lists = centroids.select(F.col("list_id").alias("vec_id"), F.col("centroid").alias("embedding"))
    found = nearest(lists, queries, nprobe, few_vectors=True)
    return found.select("query_id", F.col("vec_id").alias("list_id"), *(["rank"] if ranks else []))


def search(
    lists: DataFrame,
    centroids: DataFrame,
    queries: DataFrame,
    k: int,
    nprobe: int | None = None,
    **options: int,
) -> DataFrame:
    """(query_id, vec_id, distance, rank): top k among the vectors of the probed lists."""
    total = centroids.count()
    probed = stage(probes(queries, centroids, nprobe or probe_count(total)), "probes")
    named = probed.select("list_id").distinct().limit(FILTERED_LISTS + 1).collect()
    if len(named) <= FILTERED_LISTS:
        lists = lists.where(F.col("list_id").isin([row["list_id"] for row in named]))
    asked = queries.select("query_id", "query_vector").join(probed, "query_id")
    return ranked(nearest_in_lists(lists, asked, k, list_bound=total, **options), k)


def _lower_bounds(queries, centroids, near, far):
    """Per query and list, a distance that no vector of the list undercuts. Of two bounds the larger: the
    list's vectors lie between two spheres around its centroid; and they are nearer to it than to
    the query's own centroid, so beyond the plane half-way between the two."""
    import numpy as np

    def squared(left, right):
        out = np.einsum("ij,ij->i", left, left)[:, None] + np.einsum("ij,ij->i", right, right)[None, :] - 2.0 * left @ right.T
        return np.maximum(out, 0.0)

    square = squared(queries, centroids)
    own = square.argmin(axis=1)
    distance = np.sqrt(square)
    between = np.sqrt(squared(centroids[own], centroids))
    with np.errstate(divide="ignore", invalid="ignore"):
        plane = (square - square[np.arange(len(own)), own][:, None]) / (2.0 * between)
    plane = np.where(between > 1e-6, plane, 0.0)
    return np.maximum(np.maximum(distance - far, near - distance), np.maximum(plane, 0.0))


def _sent_extents(extents: DataFrame, broadcast_bytes: int) -> list:
    """The lists with their centroids and extents as broadcasts, in as many parts as the bound asks for; mostly one."""
    shape = extents.agg(F.count("*").alias("n"), F.max(F.size("centroid")).alias("dim")).first()
    parts = max(1, math.ceil(shape["n"] * 8 * (shape["dim"] + 3) / broadcast_bytes))
    rows = extents.select("list_id", "near", "far", F.col("centroid").cast("array<double>").alias("centroid"))
    send = extents.sparkSession.sparkContext.broadcast
    tables = (rows.where(F.pmod("list_id", F.lit(parts)) == part).toPandas() for part in range(parts))
    return [send(table.sort_values("list_id")) for table in tables if len(table)]


def _next_probes(state: DataFrame, shared, start: int, count: int) -> DataFrame:
    """(query_id, list_id): of a part's lists in the order of their bounds, those from place ``start`` on, ``count`` at
    most, that may hold one of the query's nearest: their bound does not exceed its k-th distance so far."""
    kind = state.schema["query_id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        lists = shared.value
        ids, near, far = (lists[c].to_numpy() for c in ("list_id", "near", "far"))
        centroids = np.stack(lists["centroid"].to_numpy())
        largest = float(np.einsum("ij,ij->i", centroids, centroids).max())
        rows = max(1, (1 << 21) // len(ids))
        for batch in batches:
            for a in range(0, len(batch), rows):
                part = batch.iloc[a : a + rows]
                queries = np.stack(part["query_vector"].to_numpy()).astype(np.float64)
                lower = _lower_bounds(queries, centroids, near, far)
                order = np.argsort(lower, axis=1, kind="stable")[:, start : start + count]
                bound = np.take_along_axis(lower, order, axis=1) ** 2
                kth = part["kth"].to_numpy().astype(np.float64)  # NaN: not k of them yet
                slack = 1e-9 * (np.einsum("ij,ij->i", queries, queries) + largest)
                keep = np.isnan(kth)[:, None] | (bound <= (kth + slack)[:, None])
                row, place = np.nonzero(keep)
                yield pd.DataFrame({"query_id": part["query_id"].to_numpy()[row], "list_id": ids[order[row, place]]})

    return state.select("query_id", "query_vector", "kth").mapInPandas(run, f"query_id {kind}, list_id int")


def _of_group() -> Column:
    return F.col("list_id").cast("long") * (1 << 31) + F.col("group")


def search_exact(
    lists: DataFrame,
    extents: DataFrame,
    queries: DataFrame,
    k: int,
    *,
    first_probes: int = PROBES,
    broadcast_bytes: int = BROADCAST_BYTES,
    **options: int,
) -> DataFrame:
    """(query_id, vec_id, distance, rank, lists_read): exactly the nearest vectors, without reading every list.

    ``extents`` has list_id, centroid and what ``list_extents`` gives; vectors must lie in the list of their
    nearest centroid. A query reads lists in the order of a lower bound of what they hold, and stops
    when the next bound exceeds its k-th distance. All queries go on together, round by round, with twice
    as many lists each time; the lists of a round are filtered in the scan. ``lists_read`` counts them.

    A query may have its own ``k`` column (``k`` is then the largest), and a ``group``, a number: it sees only
    vectors whose ``groups`` hold it, and reads on until it has k of those or no list is left.
    """
    named = [c for c in ("k", "group") if c in queries.columns]
    asked = stage(queries.select("query_id", "query_vector", *named), "asked")
    own_k = F.col("k") if "k" in named else F.lit(k)
    extents = stage(extents.where("size > 0"), "extents")
    total = extents.count()
    kinds = f"query_id {asked.schema['query_id'].dataType.simpleString()}, vec_id {lists.schema['vec_id'].dataType.simpleString()}"
    none = lists.sparkSession.createDataFrame([], f"{kinds}, distance double, rank int, lists_read long")
    if not total or not asked.take(1):
        return none
    sent = _sent_extents(extents, broadcast_bytes)
    groups = asked.select("group").distinct().count() if "group" in named else 1
    state = asked.withColumn("kth", F.lit(None).cast("double"))
    best, read, start, count = None, None, 0, first_probes
    while start < total:
        following = [_next_probes(state, part, start, count) for part in sent]
        probed = stage(reduce(DataFrame.unionByName, following), "probes")
        named_lists = probed.select("list_id").distinct().limit(FILTERED_LISTS + 1).collect()
        if not named_lists:
            break
        part = lists
        if len(named_lists) <= FILTERED_LISTS:
            part = lists.where(F.col("list_id").isin([row["list_id"] for row in named_lists]))
        searching = asked.join(probed, "query_id")
        if "group" in named:  # a list is searched once per group
            part = part.select("vec_id", "embedding", "list_id", F.explode("groups").alias("group"))
            part, searching = part.withColumn("list_id", _of_group()), searching.withColumn("list_id", _of_group())
        found = nearest_in_lists(
            part.select("list_id", "vec_id", "embedding"),
            searching.select("list_id", "query_id", "query_vector"),
            k,
            list_bound=total * groups,
            **options,
        )
        if best is not None:
            found = found.unionByName(best.select(*found.columns))
        mine = sized(asked.select("query_id", own_k.alias("_k")))
        best = stage(ranked(found, k).join(mine, "query_id").where("rank <= _k").drop("_k"), "best")
        full = best.groupBy("query_id").agg(F.count("*").alias("_n"), F.max("distance").alias("_last"))
        kth = F.when(F.col("_n") >= own_k, F.col("_last"))
        state = stage(asked.join(full, "query_id", "left").select("query_id", "query_vector", kth.alias("kth")), "searched")
        read = probed if read is None else read.unionByName(probed)
        start, count = start + count, count * 2
    counts = read.groupBy("query_id").agg(F.count("*").alias("lists_read"))
    return best.join(counts, "query_id").select("query_id", "vec_id", "distance", "rank", "lists_read")


# Queries of the sample from which the number of probes is chosen.
SAMPLE = 256


def probes_for_recall(placed: DataFrame, centroids: DataFrame, k: int = 10, target: float = 0.9, sample: int = SAMPLE) -> tuple[int, float]:
    """(nprobe, recall): the fewest probed lists with which the nearest ``k`` of sampled vectors are found to
    the target share, and that share.

    The queries are ``sample`` vectors chosen by the hash of their id, each looking for others; their exact
    neighbours' places in the order of the query's lists give the recall of every number of probes at once.
    """
    vectors = placed.select("vec_id", "embedding")
    chosen = vectors.orderBy(F.md5(F.col("vec_id").cast("string"))).limit(sample)
    asked = stage(chosen.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector")), "asked")
    exact = nearest(vectors, asked, k + 1).where("query_id <> vec_id").drop("rank")
    exact = stage(ranked(exact, k).select("query_id", "vec_id"), "exact")
    total_lists = centroids.count()
    wanted = exact.join(placed.select("vec_id", "list_id").join(F.broadcast(exact.select("vec_id").distinct()), "vec_id"), "vec_id")
    order = probes(asked, centroids, total_lists, ranks=True)
    places = wanted.join(order, ["query_id", "list_id"]).groupBy("rank").agg(F.count("*").alias("n")).orderBy("rank").collect()
    total, found = sum(r["n"] for r in places), 0
    for row in places:  # at most one row per list
        found += row["n"]
        if found >= target * total:
            return int(row["rank"]), found / total
    return probe_count(total_lists), 1.0
