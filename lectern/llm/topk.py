"""Exact top-k by inner product with the threshold algorithm.

The vectors lie in blocks, which are stored once, however many queries come. A block keeps, for each
dimension, its vectors sorted by their component. A query walks down all its lists at once, from the end at which its own component makes the products
largest, and scores every vector it meets in full. The products at the places it has reached bound
the score of all vectors not met yet; once that bound is below the k-th best score, none can enter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lectern.operators.ordering import dense_index
from lectern.operators.rows import top_k
from lectern.session import stage

SCALE = 256
K = 5

# Vectors of a block, and components at most; components of the queries handed to all tasks at a time; first
# steps down the lists.
BLOCK_ROWS = 8192
BLOCK_VALUES = 1 << 20
QUERY_VALUES = 1 << 20
STEPS = 16

_BLOCKS = "dim int, n int, ids binary, vectors binary, lists binary"

_EXACT = 1 << 53  # whole numbers below are exact in double precision


class Block:
    """Vectors of one dimension with a sorted list per component."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, lists: np.ndarray | None = None):
        if lists is None:
            by_id = np.argsort(ids, kind="stable")
            ids, vectors = ids[by_id], vectors[by_id]
            lists = np.argsort(vectors, axis=0, kind="stable")  # smallest first
        self.ids, self.vectors, self.lists = ids, vectors, lists
        self.sorted = np.take_along_axis(self.vectors, self.lists, axis=0)
        most = float(np.abs(self.vectors).max(initial=0))
        self.largest = most
        self.reals = self.vectors.astype(np.float64)

    def to_row(self) -> list[bytes | int]:
        small = self.largest < 1 << 15
        n, dim = self.vectors.shape
        return [
            dim,
            n,
            self.ids.astype("<i8").tobytes(),
            self.vectors.astype("<i2" if small else "<i8").tobytes(),
            self.lists.astype("<i4").tobytes(),
        ]

    @classmethod
    def from_row(cls, dim: int, n: int, ids: bytes, vectors: bytes, lists: bytes) -> Block:
        kind = "<i2" if len(vectors) == 2 * dim * n else "<i8"
        whole = np.frombuffer(vectors, kind).reshape(n, dim).astype(np.int64)
        return cls(np.frombuffer(ids, "<i8"), whole, np.frombuffer(lists, "<i4").reshape(n, dim))

    def _scores(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        if self.largest * float(np.abs(query).max(initial=0)) * len(query) < _EXACT:
            return (self.reals[rows] @ query.astype(np.float64)).astype(np.int64)
        return self.vectors[rows] @ query

    def search(self, query_id: int, query: np.ndarray, best: Best, steps: int = STEPS) -> int:
        """Improve the best list of a query; returns how many vectors were scored."""
        used = np.flatnonzero(query)
        n = len(self.ids)
        if not len(used):  # every score is zero: the smallest ids are best
            best.add(self.ids, np.zeros(n, np.int64), query_id)
            return n
        met = np.zeros(n, bool)
        scored = np.zeros(n, bool)
        weights = query[used].astype(object) if abs(self.largest) >= 1 << 25 else query[used]
        down = query[used] > 0
        depth = 0
        while depth < n:
            reach = min(n, depth + steps)
            places = np.arange(depth, reach)
            met[self.lists[n - 1 - places][:, used[down]]] = True
            met[self.lists[places][:, used[~down]]] = True
            rows = np.flatnonzero(met & ~scored)
            scored[rows] = True
            best.add(self.ids[rows], self._scores(rows, query), query_id)
            depth, steps = reach, steps * 2
            if depth < n and best.full():
                reached = np.where(down, self.sorted[n - depth, used], self.sorted[depth - 1, used])
                if (weights * reached).sum() < best.last():
                    break
        return int(scored.sum())


class Best:
    """The k best of a query so far: highest score, then smallest id; an id counts once."""

    def __init__(self, k: int):
        self.k = k
        self.ids, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def full(self) -> bool:
        return len(self.ids) >= self.k

    def last(self) -> int:
        return int(self.scores[-1])

    def add(self, ids: np.ndarray, scores: np.ndarray, query_id: int) -> None:
        use = ids != query_id
        if self.full():
            use &= scores >= self.last()
        if not use.any():
            return
        ids, scores = np.r_[self.ids, ids[use]], np.r_[self.scores, scores[use]]
        order = np.lexsort((ids, -scores))
        ids, scores = ids[order], scores[order]
        _, once = np.unique(ids, return_index=True)  # the best row of an id comes first
        once = np.sort(once)[: self.k]
        self.ids, self.scores = ids[once], scores[once]


def whole_components(vectors: DataFrame, id_col: str, vector: str, scale: int) -> DataFrame:
    """vec_id, v: floor(scale * x) of every component. Vectors null, empty, or with a null or non-finite
    component are left out, and so are rows without an id."""
    wide = F.col(vector).cast("array<double>")
    top = F.lit(float("inf"))
    finite = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (x < top) & (x > -top))
    return vectors.where(F.col(id_col).isNotNull() & (F.size(vector) > 0) & finite).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.transform(wide, lambda x: F.floor(x * F.lit(float(scale)))).cast("array<long>").alias("v"),
    )


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def _blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[Block]:
    """Blocks of vectors of one dimension, as large as they may be but for the last of each."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    waiting: dict[int, int] = {}

    def made(size: int) -> Block:
        parts = held.pop(size)
        del waiting[size]
        return Block(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))

    for batch in batches:
        ids = batch.column(0).to_numpy()
        column = batch.column(1)
        sizes = np.diff(column.offsets.to_numpy())
        flat = _matrix(column)
        begins = np.r_[0, np.cumsum(sizes)]
        for size in np.unique(sizes).tolist():
            where, room = np.flatnonzero(sizes == size), max(1, min(rows, BLOCK_VALUES // size))
            while len(where):
                part, where = np.split(where, [room - waiting.get(size, 0)])
                held.setdefault(size, []).append((ids[part], flat[begins[part][:, None] + np.arange(size)]))
                waiting[size] = waiting.get(size, 0) + len(part)
                if waiting[size] == room:
                    yield made(size)
    for size in list(held):
        yield made(size)


def stored_blocks(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Written once: a row per block with its sorted lists, from vec_id and v."""
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 3]
    names = [c.split()[0] for c in _BLOCKS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, block_rows):
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(block.to_row(), kinds, strict=True)], names=names)

    return stage(rows.select("vec_id", "v").mapInArrow(run, _BLOCKS), "topk-blocks")


def top_k_search(
    queries: DataFrame,
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    scale: int = SCALE,
    block_rows: int = BLOCK_ROWS,
    query_values: int = QUERY_VALUES,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k best vectors by integer inner product.

    Components are floor(scale * x) in 64-bit integers, whose sums wrap as Java's do. The query's own id
    is no candidate; ties go to the smaller id; fewer than k candidates give all. Vectors that are null
    or empty, or hold a null or non-finite component, take no part, nor do rows without an id; vectors
    of another dimension are no candidates. Rows that repeat an id count once, with the best of their
    scores; a repeated query is answered once, with the best over its rows. Empty tables give no rows.

    Queries go to the tasks in bounded sets, each a scan of the stored blocks; a task returns k rows per query.
    """
    spark = vectors.sparkSession
    table = stored_blocks(whole_components(vectors, id_col, vector, scale), block_rows)
    asked = dense_index(whole_components(queries, id_col, vector, scale).distinct(), "vec_id", "_at", "topk-queries")
    many, longest = asked.agg(F.count("*"), F.max(F.size("v"))).first()
    per_set = max(1, query_values // (longest or 1))
    sets = range(-(-many // per_set))
    found = None
    for number in sets:  # a set holds at most ``query_values`` components
        mine = (F.col("_at") >= number * per_set) & (F.col("_at") < (number + 1) * per_set)
        rows = asked.where(mine).select("vec_id", "v").toArrow()
        sent = spark.sparkContext.broadcast((rows.column(0).to_numpy(), [np.array(v) for v in rows.column(1).to_pylist()]))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            ids, components = sent.value
            best = [Best(k) for _ in ids]
            for row in (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)):
                block = Block.from_row(*row)
                for query_id, query, kept in zip(ids, components, best, strict=True):
                    if len(query) == block.vectors.shape[1]:
                        block.search(int(query_id), query, kept)
            counts = [len(b.ids) for b in best]
            if sum(counts):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(ids, counts)),
                        pa.array(np.concatenate([b.ids for b in best])),
                        pa.array(np.concatenate([b.scores for b in best])),
                    ],
                    names=["query_id", "vec_id", "score"],
                )

        part = table.mapInArrow(run, "query_id long, vec_id long, score long")
        if len(sets) > 1:
            part = stage(part, "topk-set")
            sent.unpersist()
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = top_k(best, "query_id", [F.desc("score"), F.asc("vec_id")], k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
