"""Hard negatives by a vertical scan of vectors (branch and bound on decomposed data).

Vectors are stored in blocks, one column of values per dimension. An anchor reads a block's columns in
the order of its own components' magnitude, the largest first, and adds up partial scores. What the
columns not read yet can still add lies between two sums, made of each column's smallest and largest
value; so every vector has a lower and an upper bound of its score. A bitmap holds the vectors that may
still be wanted; it shrinks with every few columns until the rest is scored exactly.

Two passes: the first finds every anchor's positives, the best vectors of its own label; the second the
best vectors of other labels whose scores lie in the window that each positive opens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lectern.operators.ordering import dense_index
from lectern.operators.rows import top_k
from lectern.session import stage

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
# A negative's score is between these two shares (in hundredths) of the positive's.
WINDOW = (50, 95)

# Values of a block; components of the anchors handed to all tasks at a time; columns read between two
# looks at the bounds; vectors left at which the rest of the columns is read at once.
BLOCK_VALUES = 1 << 19
ANCHOR_VALUES = 1 << 18
COLUMNS_AT_ONCE = 8
FEW = 48
# A bitmap with at most one in so many vectors left is turned into a list of their places.
SPARSE = 4

_EXACT = 1 << 53  # whole numbers below are exact in double precision
_BLOCKS = "dim int, n int, ids binary, labels binary, columns binary, smallest binary, largest binary"


def usable_rows(vectors: DataFrame, id_col: str, vector: str, label: Column, scale: int) -> DataFrame:
    """vec_id, v (floor(scale * x) of every component), label of the rows that take part: id and label known,
    a vector without null or non-finite components."""
    chosen = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("_x"), label.cast("long").alias("label")
    )
    top = F.lit(float("inf"))
    finite = F.forall("_x", lambda x: x.isNotNull() & ~F.isnan(x) & (x < top) & (x > -top))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("_x") > 0) & finite
    whole = F.transform("_x", lambda x: F.floor(x * F.lit(float(scale)))).cast("array<long>")
    return chosen.where(usable).select("vec_id", whole.alias("v"), "label")


class Block:
    """Vectors of one dimension, at least one, a column of values per component."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, columns: np.ndarray):
        self.ids, self.labels, self.columns = ids, labels, columns
        self.smallest, self.largest = columns.min(axis=1), columns.max(axis=1)

    def to_row(self) -> list[bytes | int]:
        kind = np.int64
        if max(abs(int(self.smallest.min())), abs(int(self.largest.max()))) < 1 << 15:
            kind = np.int16
        return [
            len(self.columns),
            len(self.ids),
            self.ids.astype("<i8").tobytes(),
            self.labels.astype("<i8").tobytes(),
            np.ascontiguousarray(self.columns.astype(kind)).tobytes(),
            self.smallest.astype("<i8").tobytes(),
            self.largest.astype("<i8").tobytes(),
        ]

    @classmethod
    def from_row(cls, dim: int, n: int, ids: bytes, labels: bytes, columns: bytes, smallest: bytes, largest: bytes) -> Block:
        block = cls.__new__(cls)
        block.ids, block.labels = np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8")
        kind = "<i2" if len(columns) == 2 * dim * n else "<i8"
        block.columns = np.frombuffer(columns, kind).reshape(dim, n).astype(np.int64)
        block.smallest, block.largest = np.frombuffer(smallest, "<i8"), np.frombuffer(largest, "<i8")
        return block

    def _as_reals(self) -> np.ndarray:
        if not hasattr(self, "_reals"):
            self._reals = self.columns.astype(np.float64)
        return self._reals

    def _bounded(self, anchor: np.ndarray) -> bool:
        """Whether every sum of products stays exact in double precision."""
        size = max(abs(int(self.smallest.min())), abs(int(self.largest.max())))
        return size * max(map(abs, anchor.tolist())) * len(anchor) < _EXACT

    def _distinct(self) -> bool:
        if not hasattr(self, "_once"):
            self._once = len(np.unique(self.ids)) == len(self.ids)
        return self._once

    def scan(self, anchor: np.ndarray, alive: np.ndarray, wanted: Wanted) -> int:
        """Offer the vectors of the bitmap ``alive`` that can still be wanted, with their exact scores;
        returns how many values were read. Where sums may not be exact in double precision, no bound is
        taken and all are scored in whole numbers."""
        if not self._bounded(anchor):
            wanted.offer(self.ids[alive], anchor @ self.columns[:, alive])
            return int(alive.sum()) * len(anchor)
        columns, distinct = self._as_reals(), self._distinct()
        used = np.argsort(-np.abs(anchor), kind="stable")
        used = used[anchor[used] != 0]
        weights = anchor[used].astype(np.float64)
        ends = np.stack([weights * self.smallest[used], weights * self.largest[used]])
        # what the columns from a place on can add at least and at most
        low = np.r_[np.cumsum(ends.min(axis=0)[::-1])[::-1], 0.0]
        high = np.r_[np.cumsum(ends.max(axis=0)[::-1])[::-1], 0.0]
        score, at, read = np.zeros(len(self.ids)), 0, 0
        rows = None  # the places of the vectors left, once they are a small part
        left = int(alive.sum())
        while at < len(used) and left:
            if rows is None and left * SPARSE <= len(self.ids):
                rows = np.flatnonzero(alive)
                score = score[rows]
            step = len(used) - at if left <= FEW else min(COLUMNS_AT_ONCE, len(used) - at)
            part = used[at : at + step]
            values = columns[part] if rows is None else columns[part[:, None], rows[None, :]]
            score += weights[at : at + step] @ values
            read += values.size
            at += step
            if at == len(used):
                break
            if rows is None:
                alive = alive & wanted.possible(score + low[at], score + high[at], alive, distinct)
                left = int(alive.sum())
            else:
                keep = wanted.possible(score + low[at], score + high[at], None, distinct)
                rows, score = rows[keep], score[keep]
                left = len(rows)
        if rows is None:
            wanted.offer(self.ids[alive], score[alive].astype(np.int64))
        else:
            wanted.offer(self.ids[rows], score.astype(np.int64))
        return read


class Wanted:
    """The best k ids of each of several score windows: highest score first, then smallest id; an id
    counts once per window. A window is its first and last score; None is no end."""

    def __init__(self, windows: list[tuple[int | None, int | None]], k: int):
        self.k = k
        ends = np.iinfo(np.int64)
        self.windows = [(ends.min if a is None else a, ends.max if b is None else b) for a, b in windows]
        self.ids = [np.zeros(0, np.int64) for _ in windows]
        self.scores = [np.zeros(0, np.int64) for _ in windows]

    def possible(self, low: np.ndarray, high: np.ndarray, alive: np.ndarray | None, distinct: bool) -> np.ndarray:
        """Bitmap of the vectors that may enter some window's best k, from bounds of their scores; those
        outside ``alive`` are of no account."""
        keep = np.zeros(len(low), bool)
        for i, (first, last) in enumerate(self.windows):
            border = first
            if len(self.ids[i]) >= self.k:
                border = max(border, self.scores[i][-1])
            if distinct:
                # vectors that lie in the window whatever comes: the k-th best of what they reach at least
                inside = (low >= border) & (high <= last)
                if alive is not None:
                    inside &= alive
                sure = low[inside]
                if len(sure) >= self.k:
                    border = np.partition(sure, len(sure) - self.k)[len(sure) - self.k]
            keep |= (high >= border) & (low <= last)
        return keep

    def offer(self, ids: np.ndarray, scores: np.ndarray) -> None:
        for i, (first, last) in enumerate(self.windows):
            use = (scores >= first) & (scores <= last)
            if len(self.ids[i]) >= self.k:
                use &= scores >= self.scores[i][-1]
            if not use.any():
                continue
            both, at = np.r_[self.ids[i], ids[use]], np.r_[self.scores[i], scores[use]]
            order = np.lexsort((both, -at))
            both, at = both[order], at[order]
            _, once = np.unique(both, return_index=True)  # the best row of an id comes first
            once = np.sort(once)[: self.k]
            self.ids[i], self.scores[i] = both[once], at[once]


def stored_blocks(rows: DataFrame, block_values: int = BLOCK_VALUES) -> DataFrame:
    """Written once: a row per block of vectors of one dimension, from vec_id, v, label. A task gathers
    its rows up to ``block_values`` values per block, whatever the dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def emit(dim: int) -> pa.RecordBatch:
            parts = held.pop(dim)
            ids, labels = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
            row = Block(ids, labels, np.concatenate([p[2] for p in parts]).T).to_row()
            kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
            names = [c.split()[0] for c in _BLOCKS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names=names)

        for batch in batches:
            ids, labels = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            column = batch.column(1)
            sizes = np.diff(column.offsets.to_numpy())
            flat = column.flatten().to_numpy(zero_copy_only=False)
            begins = np.r_[0, np.cumsum(sizes)]
            for dim in np.unique(sizes).tolist():
                where = np.flatnonzero(sizes == dim)
                room = max(1, block_values // dim)
                for a in range(0, len(where), room):
                    part = where[a : a + room]
                    values = flat[begins[part][:, None] + np.arange(dim)]
                    held.setdefault(dim, []).append((ids[part], labels[part], values))
                    if sum(len(p[0]) for p in held[dim]) >= room:
                        yield emit(dim)
        for dim in list(held):
            yield emit(dim)

    return stage(rows.select("vec_id", "v", "label").mapInArrow(run, _BLOCKS), "bond-blocks")


def _scan_all(blocks: DataFrame, asked: DataFrame, k: int, same_label: bool, anchor_values: int, name: str) -> DataFrame:
    """anchor_id, window (its place in the anchor's list), vec_id, score: at most k rows per window and task.

    ``asked`` has _at, vec_id, v, label and windows (pairs of scores, ends included; null: no end).
    Anchors go to the tasks in sets of a bounded number of components; a set is one scan of the blocks,
    which are read as they were stored.
    """
    spark = blocks.sparkSession
    many, longest = asked.agg(F.count("*"), F.max(F.size("v"))).first()
    per_set = max(1, anchor_values // (longest or 1))
    found = None
    sets = range(-(-many // per_set))
    for number in sets:
        mine = (F.col("_at") >= number * per_set) & (F.col("_at") < (number + 1) * per_set)
        rows = asked.where(mine).select("vec_id", "label", "v", "windows").toArrow()  # a set of bounded size
        windows = [[tuple(w.values()) for w in one] for one in rows.column(3).to_pylist()]
        vectors = [np.array(v, np.int64) for v in rows.column(2).to_pylist()]
        sent = spark.sparkContext.broadcast((rows.column(0).to_numpy(), rows.column(1).to_numpy(), vectors, windows))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            ids, labels, vectors, windows = sent.value
            wanted = [Wanted(w, k) for w in windows]
            for batch in batches:
                for i in range(batch.num_rows):
                    block = Block.from_row(*(c[i].as_py() for c in batch.columns))
                    for anchor_id, label, vector, one in zip(ids, labels, vectors, wanted, strict=True):
                        if len(vector) != len(block.columns):
                            continue
                        fit = block.labels == label if same_label else block.labels != label
                        block.scan(vector, fit & (block.ids != anchor_id), one)
            out = [
                (anchor_id, w, i, s)
                for anchor_id, one in zip(ids.tolist(), wanted, strict=True)
                for w, (some, scores) in enumerate(zip(one.ids, one.scores, strict=True))
                for i, s in zip(some.tolist(), scores.tolist(), strict=True)
            ]
            if out:
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), [pa.int64(), pa.int32(), pa.int64(), pa.int64()], strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["anchor_id", "window", "vec_id", "score"])

        part = stage(blocks.mapInArrow(run, "anchor_id long, window int, vec_id long, score long"), name)
        sent.unpersist()
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "anchor_id long, window int, vec_id long, score long")
    return found


def hard_negatives(
    vectors: DataFrame,
    anchors: Column | None = None,
    id_col: str = "vec_id",
    vector: str = "embedding",
    label: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    window: tuple[int, int] = WINDOW,
    scale: int = SCALE,
    block_values: int = BLOCK_VALUES,
    anchor_values: int = ANCHOR_VALUES,
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    An anchor's positives are the ``positives`` best other rows of its label by integer inner product; for
    each of them, the ``negatives`` best rows of other labels n with low * positive <= 100 * n <= high *
    positive. Higher scores come first, ties go to the smaller id; fewer rows than asked for give all.

    ``anchors`` is a condition on the id column (all rows, if none), ``label`` an expression of the label
    (by default the column of that name). Components are floor(scale * x) in 64-bit integers, whose sums
    wrap as Java's do. Rows without id or label take no part, nor do vectors that are null or empty or
    hold a null or non-finite component; vectors of another dimension never meet. An id that is repeated
    is never its own partner and is named once per list, with its best score there; as an anchor it
    asks once, with its smallest label and vector. An anchor without positives, a positive without a
    score in its window (any below zero), and empty tables give no rows. Further columns are ignored.
    """
    label = F.col("label") if label is None else label
    rows = stage(usable_rows(vectors, id_col, vector, label, scale), "bond-rows")
    blocks = stored_blocks(rows, block_values)
    chosen = rows.where(anchors) if anchors is not None else rows
    once = chosen.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("_row")).select("vec_id", "_row.label", "_row.v")
    asked = dense_index(once, "vec_id", "_at", "bond-anchors")

    everything = F.array(F.struct(F.lit(None).cast("long").alias("first"), F.lit(None).cast("long").alias("last")))
    near = _scan_all(blocks, asked.withColumn("windows", everything), positives, True, anchor_values, "bond-positives")
    best = near.groupBy("anchor_id", "vec_id").agg(F.max("score").alias("score"))
    best = top_k(best, "anchor_id", [F.desc("score"), F.asc("vec_id")], positives)
    best = stage(best.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "bond-best")

    # equal scores open the same window; an anchor has at most as many windows as positives
    scores = best.where("positive_score >= 0").groupBy("anchor_id").agg(F.sort_array(F.collect_set("positive_score")).alias("scores"))
    scores = stage(scores, "bond-scores")
    low, high = window
    opened = F.expr(  # ceil(low * s / 100) and floor(high * s / 100) without overflow
        "transform(scores, s -> struct("
        f"s div 100 * {low} + (s % 100 * {low} + 99) div 100 AS first, "
        f"s div 100 * {high} + (s % 100 * {high}) div 100 AS last))"
    )
    with_windows = asked.join(scores, F.col("vec_id") == F.col("anchor_id")).select("vec_id", "v", "label", opened.alias("windows"))
    with_windows = dense_index(with_windows, "vec_id", "_at", "bond-windows")
    far = _scan_all(blocks, with_windows, negatives, False, anchor_values, "bond-negatives")
    far = far.groupBy("anchor_id", "window", "vec_id").agg(F.max("score").alias("negative_score"))
    ranked = top_k(far, ["anchor_id", "window"], [F.desc("negative_score"), F.asc("vec_id")], negatives)
    scored = ranked.join(scores, "anchor_id").withColumn("positive_score", F.get("scores", "window"))
    return scored.join(best, ["anchor_id", "positive_score"]).select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        "negative_score",
    )
