"""Exact nearest neighbours by squared Euclidean distance.

Distances are computed blockwise in numpy inside tasks: a matrix product finds the vectors that may
be among the nearest, and their distances are then summed anew from the differences, so that equal
vectors get equal distances. A block hands on at most ``k`` rows per query, never all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F

from lectern.operators.rows import BROADCAST_ROWS, top_k

# Largest side that is sent to every task, in bytes of its double-precision vectors.
BROADCAST_BYTES = 64 << 20

# Vectors and queries per cell when neither side may be sent to every task.
CELL_VECTORS = 20_000
CELL_QUERIES = 5_000


def _block_nearest():
    """The numpy kernel, made here so that it travels to the workers by value."""

    import numpy as np

    def candidates(block, pool, count):
        """(query row, pool row) pairs that may belong to the ``count`` nearest."""
        lengths = np.einsum("ij,ij->i", pool, pool)
        rough = block @ pool.T  # becomes the distance less the query's own length
        rough *= -2.0
        rough += lengths
        if count == 1:
            border = rough.min(axis=1)
        else:
            border = np.partition(rough, count - 1, axis=1)[:, count - 1]
        own = np.einsum("ij,ij->i", block, block)
        slack = 1e-9 * (own + lengths.max() + 1e-300)
        return np.nonzero(rough <= (border + slack)[:, None])

    def first_k(query_row, pool_row, distance, k):
        """The k rows per query with the smallest distance; the earlier row wins a tie."""
        order = np.lexsort((pool_row, distance, query_row))
        query_row, pool_row, distance = query_row[order], pool_row[order], distance[order]
        keep = np.arange(len(query_row)) - np.searchsorted(query_row, query_row, side="left") < k
        return query_row[keep], pool_row[keep], distance[keep]

    def distinct(vectors):
        """Distinct vectors in the order of their first row, and the rows of each in order."""
        _, first, group = np.unique(vectors, axis=0, return_index=True, return_inverse=True)
        by_first = np.argsort(first)
        number = np.empty(len(first), dtype=np.int64)
        number[by_first] = np.arange(len(first))
        group = number[group.reshape(-1)]
        rows = np.argsort(group, kind="stable")
        counts = np.bincount(group)
        return vectors[first[by_first]], rows, np.cumsum(counts) - counts, counts

    def nearest(vectors, queries, k):
        """(query row, vector row, distance) of the k nearest vectors per query; rows of ``vectors``
        are in id order, and the earlier row wins a tie."""
        pool, copies, found = vectors, None, []
        for start in range(0, len(queries), 256):
            block = queries[start : start + 256]
            query_row, pool_row = candidates(block, pool, min(k, len(pool)))
            if copies is None and len(query_row) > 4 * k * len(block) + 1000:
                # Many ties: equal vectors are looked at once, and their rows are put back below.
                pool, *copies = distinct(vectors)
                query_row, pool_row = candidates(block, pool, min(k, len(pool)))
            exact = np.empty(len(query_row))
            for at in range(0, len(query_row), 100_000):
                part = slice(at, at + 100_000)
                gap = pool[pool_row[part]] - block[query_row[part]]
                exact[part] = np.einsum("ij,ij->i", gap, gap)
            best = first_k(query_row, pool_row, exact, k)
            if copies is not None:
                rows, starts, counts = copies
                query_row, pool_row, exact = best
                taken = np.minimum(counts[pool_row], k)  # k rows of one vector are enough
                within = np.arange(taken.sum()) - np.repeat(np.cumsum(taken) - taken, taken)
                vector_row = rows[np.repeat(starts[pool_row], taken) + within]
                best = first_k(np.repeat(query_row, taken), vector_row, np.repeat(exact, taken), k)
            found.append((best[0] + start, *best[1:]))
        return tuple(np.concatenate(part) for part in zip(*found))

    return nearest


def _small_side(df: DataFrame, id_col: str, vector_col: str, limit_bytes: int):
    """Ids and matrix of a side within the bound, else None; reads at most one row beyond it."""
    first = df.select(F.size(vector_col).alias("dim")).first()
    if first is None:
        return [], None
    rows = max(limit_bytes // (8 * max(first["dim"], 1)), 1)
    table = df.select(id_col, vector_col).limit(rows + 1).toPandas()
    if len(table) > rows:
        return None
    import numpy as np

    table = table.sort_values(id_col, kind="stable")
    return table[id_col].tolist(), np.stack(table[vector_col].to_numpy()).astype(np.float64)


def _types(vectors: DataFrame, queries: DataFrame) -> str:
    query = queries.schema["query_id"].dataType.simpleString()
    vector = vectors.schema["vec_id"].dataType.simpleString()
    return f"query_id {query}, vec_id {vector}, distance double"


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    *,
    few_vectors: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    cell_vectors: int = CELL_VECTORS,
    cell_queries: int = CELL_QUERIES,
) -> DataFrame:
    """(query_id, vec_id, distance, rank): the k nearest vectors of every query; ties by smaller id.

    ``vectors`` has vec_id and embedding, ``queries`` has query_id and query_vector. Whichever side
    is within the bound is sent to every task, and the other is scanned in place. When neither is,
    both are cut into cells of bounded size and every cell pair is one task's work. The queries are
    tried first, unless ``few_vectors`` says that the vectors are the smaller side.
    """
    schema = _types(vectors, queries)

    def over_queries() -> DataFrame | None:
        small = _small_side(queries, "query_id", "query_vector", broadcast_bytes)
        return None if small is None else ranked(_scan_vectors(vectors, small, k, schema), k)

    def over_vectors() -> DataFrame | None:
        small = _small_side(vectors, "vec_id", "embedding", broadcast_bytes)
        return None if small is None else _scan_queries(queries, small, k, schema)

    ways = [over_vectors, over_queries] if few_vectors else [over_queries, over_vectors]
    for way in ways:
        found = way()
        if found is not None:
            return found
    return ranked(_by_cells(vectors, queries, k, schema, cell_vectors, cell_queries), k)


def ranked(candidates: DataFrame, k: int) -> DataFrame:
    """The k nearest candidates per query with their rank; ties by smaller id."""
    return top_k(candidates, "query_id", [F.col("distance"), F.col("vec_id")], k)


def _scan_vectors(vectors: DataFrame, small, k: int, schema: str) -> DataFrame:
    """Every task compares its vectors with all queries, batch by batch, and sends its k best per query."""
    shared = vectors.sparkSession.sparkContext.broadcast(small)
    kernel = _block_nearest()

    def scan(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        ids, queries = shared.value
        ids, best = np.array(ids), None
        for batch in batches:
            if batch.empty or not len(ids):
                continue
            batch = batch.sort_values("vec_id", kind="stable")
            matrix = np.stack(batch["embedding"].to_numpy()).astype(np.float64)
            query_row, vector_row, distance = kernel(matrix, queries, k)
            found = pd.DataFrame(
                {"_row": query_row, "vec_id": batch["vec_id"].to_numpy()[vector_row], "distance": distance}
            )
            if best is not None:  # of all batches so far, the k best per query
                both = pd.concat([best, found]).sort_values(["_row", "distance", "vec_id"], kind="stable")
                found = both[both.groupby("_row").cumcount() < k]
            best = found
        if best is not None:
            yield pd.DataFrame(
                {"query_id": ids[best["_row"]], "vec_id": best["vec_id"].to_numpy(), "distance": best["distance"].to_numpy()}
            )

    return vectors.select("vec_id", "embedding").mapInPandas(scan, schema)


def _scan_queries(queries: DataFrame, small, k: int, schema: str) -> DataFrame:
    """Every task compares its queries with all vectors; the result is final, nothing is shuffled."""
    shared = queries.sparkSession.sparkContext.broadcast(small)
    kernel = _block_nearest()

    def scan(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        ids, vectors = shared.value
        ids = np.array(ids)
        for batch in batches:
            if batch.empty or not len(ids):
                continue
            matrix = np.stack(batch["query_vector"].to_numpy()).astype(np.float64)
            query_row, vector_row, distance = kernel(vectors, matrix, k)
            first = np.searchsorted(query_row, query_row, side="left")
            yield pd.DataFrame(
                {
                    "query_id": batch["query_id"].to_numpy()[query_row],
                    "vec_id": ids[vector_row],
                    "distance": distance,
                    "rank": (np.arange(len(query_row)) - first + 1).astype(np.int32),
                }
            )

    return queries.select("query_id", "query_vector").mapInPandas(scan, schema + ", rank int")


def _numbers(count: Column) -> Column:
    """Array of 0 .. count-1, for a count of at least 1."""
    return F.sequence(F.lit(0).cast("long"), count.cast("long") - 1)


def _by_cells(
    vectors: DataFrame, queries: DataFrame, k: int, schema: str, cell_vectors: int, cell_queries: int
) -> DataFrame:
    """Both sides in cells of bounded size; each pair of cells is one group.

    Ids are unique, so their hash spreads them evenly whatever the vectors look like.
    """
    vector_cells = math.ceil(vectors.count() / cell_vectors)
    query_cells = math.ceil(queries.count() / cell_queries)
    left = vectors.select(
        "vec_id",
        "embedding",
        F.pmod(F.xxhash64("vec_id"), F.lit(vector_cells)).alias("cell"),
        F.explode(_numbers(F.lit(query_cells))).alias("part"),
    )
    right = queries.select(
        "query_id",
        "query_vector",
        F.explode(_numbers(F.lit(vector_cells))).alias("cell"),
        F.pmod(F.xxhash64("query_id"), F.lit(query_cells)).alias("part"),
    )
    return nearest_in_cells(left, right, ["cell", "part"], k, schema)


def nearest_in_cells(vectors: DataFrame, queries: DataFrame, cell: list[str], k: int, schema: str) -> DataFrame:
    """At most k (query_id, vec_id, distance) rows per query and cell; cells must be of bounded size."""
    kernel = _block_nearest()

    def match(left, right):
        import numpy as np
        import pandas as pd

        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "distance": []})
        left = left.sort_values("vec_id", kind="stable")
        query_row, vector_row, distance = kernel(
            np.stack(left["embedding"].to_numpy()).astype(np.float64),
            np.stack(right["query_vector"].to_numpy()).astype(np.float64),
            k,
        )
        return pd.DataFrame(
            {
                "query_id": right["query_id"].to_numpy()[query_row],
                "vec_id": left["vec_id"].to_numpy()[vector_row],
                "distance": distance,
            }
        )

    return vectors.groupBy(*cell).cogroup(queries.groupBy(*cell)).applyInPandas(match, schema)


def nearest_in_lists(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    *,
    list_bound: int,
    cell_vectors: int = CELL_VECTORS,
    cell_queries: int = CELL_QUERIES,
) -> DataFrame:
    """At most k (query_id, vec_id, distance) rows per query and cell, among the vectors of its lists.

    ``vectors`` has list_id, vec_id, embedding; ``queries`` has list_id, query_id, query_vector. A
    list that holds very many vectors or is asked by very many queries is salted on that side and the
    other side is copied to the salts, so no group outgrows a cell. ``list_bound`` is the known upper
    bound of the number of lists, which is what makes the table of salts small enough to broadcast.
    """
    schema = _types(vectors, queries)
    sizes = vectors.groupBy("list_id").agg(F.count("*").alias("_vectors"))
    asked = queries.groupBy("list_id").agg(F.count("*").alias("_queries"))
    salts = sizes.join(asked, "list_id").select(
        "list_id",
        F.ceil(F.col("_vectors") / cell_vectors).alias("_vector_salts"),
        F.ceil(F.col("_queries") / cell_queries).alias("_query_salts"),
    )
    if list_bound <= BROADCAST_ROWS:
        salts = F.broadcast(salts)  # one row per list
    left = vectors.join(salts, "list_id").select(
        "list_id",
        "vec_id",
        "embedding",
        F.pmod(F.xxhash64("vec_id"), "_vector_salts").alias("cell"),
        F.explode(_numbers(F.col("_query_salts"))).alias("part"),
    )
    right = queries.join(salts, "list_id").select(
        "list_id",
        "query_id",
        "query_vector",
        F.explode(_numbers(F.col("_vector_salts"))).alias("cell"),
        F.pmod(F.xxhash64("query_id"), "_query_salts").alias("part"),
    )
    return nearest_in_cells(left, right, ["list_id", "cell", "part"], k, schema)
