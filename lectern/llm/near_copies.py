"""Near copies: documents whose sets of five-word shingles have a Jaccard similarity of at least 0.8.

Candidates come from SimHash fingerprints by multi-index hashing. A fingerprint has 320 bits, each the
majority of that bit in the hashes of the shingles; sets at 0.8 differ in a bit with a probability of
0.15. The bits are cut into 20 segments of 16. A fingerprint looks up, in the table of each segment, its
own value and every value one bit away; two that differ in at most one bit of some segment meet, and
their whole distance decides whether they are candidates. By the formula 0.998 of lone pairs at 0.8 meet.

Candidates are grouped by their connected components, and within these every two sets are compared, so
that texts which only share passages are not linked, however many they are. What is linked to what never
travels as pairs: a task gives each of its members one link, to the smallest member of its part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from lectern.llm.common import BATCH_ROWS, BATCH_SETTING, map_batches, slices_by_bytes
from lectern.llm.components import connected_components
from lectern.llm.simhash import shingle_hashes
from lectern.operators.rows import sized
from lectern.session import setting, stage

SHINGLE_WORDS = 5
SIMILARITY = 0.8
SEGMENTS, SEGMENT_BITS = 20, 16
BITS = SEGMENTS * SEGMENT_BITS
# Bits in which the fingerprints of candidates differ at most; sets at 0.8 differ in 48 on average.
CANDIDATE_BITS = 80

# Fingerprints of a part of a segment's table; of a part that is crowded, those of a cell.
PART_ROWS = 1 << 17
CELL_ROWS = 1 << 17
# Bytes of the sets of a component's cell.
CELL_BYTES = 8 << 20

_SLICE_BYTES = 2 << 20
_PAIRS = 1 << 18
_WORDS = BITS // 64
_ODD = np.random.default_rng(42).integers(0, 1 << 63, _WORDS, np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: bytes, shingle_words: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles; a text without words has the one hash zero."""
    return np.unique(np.array(shingle_hashes(text, shingle_words) or [0], np.uint64))


def fingerprints(sets: list[np.ndarray]) -> np.ndarray:
    """A row of 64-bit words per set: a bit is set if it is set in over half the hashes."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    starts = np.cumsum(sizes) - sizes
    flat = np.concatenate(sets)
    out = np.empty((len(sets), _WORDS), np.uint64)
    for i, odd in enumerate(_ODD):
        mixed = (flat ^ (flat >> np.uint64(31))) * odd
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
        votes = np.zeros((len(sets), 64), np.int64)
        for a in range(0, len(mixed), 1 << 16):  # the bits of this many hashes are unpacked at a time
            part = mixed[a : a + (1 << 16)]
            owner = np.searchsorted(starts, np.arange(a, a + len(part)), side="right") - 1
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1)
            votes[owner[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int32)
        out[:, i] = np.packbits(votes * 2 > sizes[:, None], axis=1).view(np.uint64).reshape(-1)
    return out


def _digest(one: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(one.tobytes())


def sketches(docs: DataFrame, id_col: str, text: str, shingle_words: int) -> DataFrame:
    """doc_id, node (hash of the set: equal sets are one node), n (size of the set), bits (fingerprint)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).cast(pa.binary()).fill_null(b"")
        nodes, sizes, bits = [], [], []
        for a, b in slices_by_bytes(pc.binary_length(texts).to_pylist(), _SLICE_BYTES):
            sets = [shingle_set(t, shingle_words) for t in texts.slice(a, b - a).to_pylist()]
            nodes += map(_digest, sets)
            sizes += map(len, sets)
            bits += [row.tobytes() for row in fingerprints(sets)]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(np.array(nodes, np.uint64).view(np.int64)),
                pa.array(sizes, pa.int64()),
                pa.array(bits, pa.binary()),
            ],
            names=["doc_id", "node", "n", "bits"],
        )

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(id_col, text), run, f"doc_id {kind}, node long, n long, bits binary")


class Parts:
    """Connected parts of numbered things, joined by pairs; a part is named by its smallest member."""

    def __init__(self, count: int):
        self.label = np.arange(count)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        low, high = np.minimum(self.label[a], self.label[b]), np.maximum(self.label[a], self.label[b])
        apart = low != high
        if not apart.any():
            return
        edges = np.unique(np.stack([low[apart], high[apart]], axis=1), axis=0)
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while parent.get(top, top) != top:
                top = parent[top]
            while parent.get(x, x) != top:
                parent[x], x = top, parent[x]
            return top

        for x, y in edges.tolist():
            x, y = root(x), root(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
        names = np.array(list(parent), np.int64)
        moved = np.arange(len(self.label))
        moved[names] = [root(x) for x in names.tolist()]
        self.label = moved[self.label]

    def links(self, nodes: np.ndarray) -> pa.Table:
        """a, b: one link per member that is not its part's first."""
        rest = np.flatnonzero(self.label != np.arange(len(self.label)))
        return pa.table({"a": pa.array(nodes[self.label[rest]]), "b": pa.array(nodes[rest])})


def _meetings(values: np.ndarray, owner: np.ndarray, wanted: np.ndarray, low_bits: int):
    """Chunks of (row, owner's row) that meet: owners of one value, owners one low bit apart, and visitors with
    the owners of the value that they want."""
    owners = np.flatnonzero(owner)
    owners = owners[np.argsort(values[owners], kind="stable")]
    held = values[owners]
    visitors = np.flatnonzero(~owner)
    asking = [(visitors, wanted[visitors], False), (owners, held, True)]
    for bit in range(low_bits):
        have = owners[(held >> bit) & 1 == 1]
        asking.append((have, values[have] ^ (1 << bit), False))
    for rows, looked_up, same in asking:
        begins, ends = np.searchsorted(held, looked_up, "left"), np.searchsorted(held, looked_up, "right")
        if same:  # each pair of one value once
            begins = np.arange(len(rows)) + 1
        counts = np.maximum(ends - begins, 0)
        total = np.cumsum(counts)
        a = 0
        while a < len(rows):
            b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + _PAIRS, "right")))
            many = counts[a:b]
            if many.any():
                left = np.repeat(rows[a:b], many)
                within = np.arange(len(left)) - np.repeat(np.cumsum(many) - many, many)
                yield left, owners[np.repeat(begins[a:b], many) + within]
            a = b


def _candidates(table: pa.Table, similarity: float, candidate_bits: int, low_bits: int) -> pa.Table:
    """Links between the members of a part of a segment's table whose fingerprints and sizes are near enough."""
    nodes, sizes = table.column("node").to_numpy(), table.column("n").to_numpy().astype(np.float64)
    bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint64).reshape(-1, _WORDS)
    values, wanted = table.column("value").to_numpy(), table.column("wanted").to_numpy()
    parts = Parts(len(nodes))
    for a, b in _meetings(values, values == wanted, wanted, low_bits):
        near = (np.minimum(sizes[a], sizes[b]) >= similarity * np.maximum(sizes[a], sizes[b]) - 1e-9) & (nodes[a] != nodes[b])
        a, b = a[near], b[near]
        if len(a):
            near = np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1, dtype=np.int64) <= candidate_bits
            parts.join(a[near], b[near])
    return parts.links(nodes)


def candidate_links(
    nodes: DataFrame,
    similarity: float = SIMILARITY,
    candidate_bits: int = CANDIDATE_BITS,
    part_rows: int = PART_ROWS,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """(a, b): links that connect all nodes which differ in at most one bit of some segment and in at most
    ``candidate_bits`` in all, and whose sizes allow the similarity.

    A segment's table is cut into parts by the first bits of the value. A node goes to the part of its
    own value, and as a visitor to those one of whose first bits is the other way round (only from one to
    zero, so that a pair meets once); the other bits are flipped within the part. A part with more rows
    than ``cell_rows`` is cut into cells by a hash, and every two cells are one task's work.
    """
    count = nodes.count()
    first_bits = 0
    while count >> first_bits > part_rows and first_bits < SEGMENT_BITS:
        first_bits += 1
    low_bits = SEGMENT_BITS - first_bits

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        """A row per node, segment and part it goes to."""
        bits = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint16).reshape(-1, SEGMENTS).astype(np.int64)
        row, segment = np.divmod(np.arange(bits.size), SEGMENTS)
        values = bits.reshape(-1)
        rows, segments, held, wanted = [row], [segment], [values], [values]
        for bit in range(low_bits, SEGMENT_BITS):
            have = np.flatnonzero((values >> bit) & 1)
            rows.append(row[have])
            segments.append(segment[have])
            held.append(values[have])
            wanted.append(values[have] ^ (1 << bit))
        take = pa.array(np.concatenate(rows))
        wanted = np.concatenate(wanted)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate(segments) << SEGMENT_BITS | wanted >> low_bits, pa.int64()),
                pa.array(np.concatenate(held), pa.int64()),
                pa.array(wanted, pa.int64()),
                *[batch.column(i).take(take) for i in (0, 1, 2)],
            ],
            names=["part", "value", "wanted", "node", "n", "bits"],
        )

    schema = "part long, value long, wanted long, node long, n long, bits binary"
    rows = map_batches(nodes.select("node", "n", "bits"), run, schema)
    sizes = rows.groupBy("part").agg(F.ceil(F.count("*") / cell_rows).cast("int").alias("cells"))
    cells = stage(sizes, "near-parts")
    spread = rows.join(sized(cells), "part").withColumn("cell", F.pmod(F.xxhash64("node"), "cells").cast("int"))
    # every two cells meet; a part of one cell has the pair of it with itself
    other = F.explode(F.when(F.col("cells") == 1, F.array(F.lit(0))).otherwise(F.filter(F.sequence(F.lit(0), F.col("cells") - 1), lambda c: c != F.col("cell"))))
    paired = spread.withColumn("other", other).select(
        "part", F.least("cell", "other").alias("x"), F.greatest("cell", "other").alias("y"), "value", "wanted", "node", "n", "bits"
    )
    match = lambda table: _candidates(table, similarity, candidate_bits, low_bits)
    return paired.groupBy("part", "x", "y").applyInArrow(match, "a long, b long").distinct()


def _sets(docs: DataFrame, text: str, shingle_words: int) -> DataFrame:
    """node, hashes: the set of each row's text, 32 bits a shingle."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(0).cast(pa.binary()).fill_null(b"")
        digests, low = [], []
        for a, b in slices_by_bytes(pc.binary_length(texts).to_pylist(), _SLICE_BYTES):
            for text in texts.slice(a, b - a).to_pylist():
                one = shingle_set(text, shingle_words)
                digests.append(_digest(one))
                low.append(np.unique(one.astype(np.uint32)).tobytes())
        nodes = np.array(digests, np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(low, pa.binary())], names=["node", "hashes"])

    return map_batches(docs.select(text), run, "node long, hashes binary")


def similar_parts(sets: list[np.ndarray], similarity: float) -> Parts:
    """The parts of some sets that are connected by a Jaccard similarity of at least ``similarity``.

    A set is compared with all others at once, through the lists of the sets that hold each hash. It need
    not be if all that have not been compared yet are in one part with it; so a group of copies of
    one text takes few comparisons, and sets that have nothing near them one each.
    """
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    parts, waiting = Parts(len(sets)), np.ones(len(sets), bool)
    while waiting.any():
        labels = parts.label[waiting]
        names, many = np.unique(labels, return_counts=True)
        if len(names) == 1:
            break
        # of the smallest part that waits, the first
        at = int(np.flatnonzero(waiting)[np.flatnonzero(labels == names[many.argmin()])[0]])
        waiting[at] = False
        begins, ends = np.searchsorted(flat, sets[at], "left"), np.searchsorted(flat, sets[at], "right")
        counts = ends - begins
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        both = np.bincount(owner[np.repeat(begins, counts) + within], minlength=len(sets))
        near = np.flatnonzero(both >= similarity * (sizes + sizes[at] - both) - 1e-9)
        parts.join(np.full(len(near), at), near)
    return parts


def verified_links(members: DataFrame, sets: DataFrame, similarity: float = SIMILARITY, cell_bytes: int = CELL_BYTES) -> DataFrame:
    """(a, b): links that connect the nodes of each candidate component as their sets' similarity does.

    ``members`` has node, component and n. A set travels once to its component, or, where the component's
    sets exceed ``cell_bytes``, once for every two cells that it is in; every two sets meet in some task.
    """
    total = members.groupBy("component").agg(F.ceil(F.sum("n") * 4 / cell_bytes).cast("int").alias("cells"))
    total = stage(total, "near-cells")
    spread = members.join(sized(total), "component").withColumn("cell", F.pmod(F.xxhash64("node"), "cells").cast("int"))
    other = F.explode(F.when(F.col("cells") == 1, F.array(F.lit(0))).otherwise(F.filter(F.sequence(F.lit(0), F.col("cells") - 1), lambda c: c != F.col("cell"))))
    paired = spread.withColumn("other", other).select("node", "component", F.least("cell", "other").alias("x"), F.greatest("cell", "other").alias("y"))

    def match(table: pa.Table) -> pa.Table:
        found = [np.frombuffer(s, np.uint32) for s in table.column("hashes").to_pylist()]
        return similar_parts(found, similarity).links(table.column("node").to_numpy())

    return paired.join(sized(sets), "node").groupBy("component", "x", "y").applyInArrow(match, "a long, b long").distinct()


def similar_components(
    nodes: DataFrame, docs: DataFrame, id_col: str, text: str, shingle_words: int, similarity: float, **options: int
) -> DataFrame:
    """node, component of the nodes (node, n, bits, first_id) that are near to another one."""
    cells = {"cell_bytes": options.pop("cell_bytes", CELL_BYTES)}
    meeting = stage(connected_components(candidate_links(nodes, similarity, **options)), "near-candidates")
    members = stage(meeting.join(nodes.select("node", "n", "first_id"), "node"), "near-members")
    ids = sized(stage(members.select("first_id").distinct(), "near-ids"))  # one document of each node
    texts = docs.join(ids, docs[id_col].eqNullSafe(ids["first_id"]), "left_semi")
    sets = _sets(texts, text, shingle_words).join(sized(members.select("node")), "node", "left_semi")
    sets = stage(sets.dropDuplicates(["node"]), "near-sets")
    return connected_components(stage(verified_links(members.drop("first_id"), sets, similarity, **cells), "near-links"))


def one_per_group(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    similarity: float = SIMILARITY,
    **options: int,
) -> DataFrame:
    """The rows that stay: of every component of similar documents the one with the smallest id.

    Null, empty and white-space texts are equal. Rows whose id is null stay only if they are alone in
    their component's ids; of rows that repeat the id that stays, all stay. An empty table gives no rows.
    Further columns are carried along, whatever their names.
    """
    with setting(docs.sparkSession, BATCH_SETTING, str(BATCH_ROWS)):
        rows = stage(sketches(docs, id_col, text, shingle_words), "near-sketches")
    nodes = rows.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.first("n").alias("n"), F.first("bits").alias("bits"))
    nodes = stage(nodes, "near-nodes")
    with setting(docs.sparkSession, BATCH_SETTING, str(BATCH_ROWS)):
        found = similar_components(nodes, docs, id_col, text, shingle_words, similarity, **options)
    labelled = nodes.select(F.col("node").alias("own"), "first_id").join(found, F.col("own") == F.col("node"), "left")
    labelled = stage(labelled.select("own", "first_id", F.coalesce("component", "own").alias("component")), "near-labels")
    smallest = stage(labelled.groupBy("component").agg(F.min("first_id").alias("component_id")), "near-smallest")
    groups = stage(labelled.join(sized(smallest), "component").select(F.col("own").alias("node"), "component_id"), "near-groups")
    kept = rows.select("doc_id", "node").join(sized(groups), "node").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = sized(stage(kept.select(F.col("doc_id").alias("keep")).distinct(), "near-kept"))
    return docs.join(kept, docs[id_col].eqNullSafe(kept["keep"]), "left_semi")
