"""Near-duplicates by SimHash: fingerprints of 64 bits, found by multi-index hashing, linked at a few
differing bits, and grouped by connected components.

Multi-index hashing cuts a fingerprint into segments. If two fingerprints differ in at most r bits,
then in some segment i they differ in at most t_i bits, for any radii with sum(t_i + 1) = r + 1. Every
segment has a table of the fingerprints by its value; a fingerprint looks up all values within the
radius of its own, and full distances decide.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from lectern.llm.common import map_batches, slices_by_bytes
from lectern.llm.components import connected_components
from lectern.operators.rows import sized
from lectern.session import stage

SHINGLE_WORDS = 4
LINK_BITS = 4
SEED = 42
BITS = 64

# Entries of a table value from which its members are linked through shared neighbours, not pair by pair.
CROWDED = 2048

_SLICE_BYTES = 4 << 20
_MEETING_COST = 0.05  # of comparing two fingerprints, against sending a look-up


def shingle_hashes(text: bytes, shingle_words: int = SHINGLE_WORDS) -> list[int]:
    """XXH64 of every shingle of the lower-cased text, repeats included."""
    words = text.lower().split()  # bytes: only A-Z change, and only ASCII white space separates
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) < shingle_words:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - shingle_words + 1].tolist(), ends[shingle_words - 1 :].tolist(), strict=True)
    return [digest(joined[a:b], SEED) for a, b in spans]


def _majority(hashes: list[list[int]]) -> np.ndarray:
    """One fingerprint per list: a bit is set if it is set in over half the hashes."""
    counts = np.fromiter(map(len, hashes), np.int64, len(hashes))
    flat = np.fromiter((h for one in hashes for h in one), np.uint64, int(counts.sum()))
    votes = np.zeros((len(hashes), BITS), np.int64)
    owner = np.repeat(np.arange(len(hashes)), counts)
    for start in range(0, len(flat), 1 << 16):  # the bits of this many hashes are unpacked at a time
        part = flat[start : start + (1 << 16)]
        bits = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        rows = owner[start : start + len(part)]
        first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        votes[rows[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
    packed = np.packbits(votes * 2 > counts[:, None], axis=1)
    return packed.view(">u8").reshape(-1).astype(np.uint64)


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """doc_id, fingerprint (64 bits as a long). Null counts as empty; no words: zero."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).cast(pa.binary())
        sizes = texts.fill_null(b"").to_pylist()
        out = []
        for a, b in slices_by_bytes([len(t) for t in sizes], _SLICE_BYTES):
            out.append(_majority([shingle_hashes(t, shingle_words) for t in sizes[a:b]]))
        values = np.concatenate(out).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], names=["doc_id", "fingerprint"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(id_col, text), run, f"doc_id {kind}, fingerprint long")


def segments(link_bits: int, count: int) -> list[tuple[int, int, int]]:
    """Offset, width and radius of each segment; sum(radius + 1) = link_bits + 1."""
    out, offset = [], 0
    for i in range(count):
        width = BITS // count + (i < BITS % count)
        radius = (link_bits + 1) // count + (i < (link_bits + 1) % count) - 1
        out.append((offset, width, radius))
        offset += width
    return out


def best_segments(fingerprints: int, link_bits: int) -> int:
    """The number of segments with the least work for so many fingerprints. Long segments have more
    values to look up, short ones more chance meetings per value; any number finds the same links."""

    def work(count: int) -> float:
        parts = segments(link_bits, count)
        return sum(
            math.comb(width, r) * (1 + _MEETING_COST * fingerprints / 2**width)
            for _, width, radius in parts
            for r in range(radius + 1)
        )

    return min(range(2, max(2, link_bits) + 1), key=work) if link_bits else 1


def _ball(width: int, radius: int) -> list[int]:
    """Masks of at most ``radius`` bits of a segment."""
    return [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]


def _value(fingerprint: Column, offset: int, width: int) -> Column:
    if width == BITS:
        return fingerprint
    return F.shiftrightunsigned(fingerprint, offset).bitwiseAND(F.lit((1 << width) - 1))


def _values(fingerprint: Column, number: int, part: tuple[int, int, int], ball: bool) -> Column:
    """(segment, value) of one segment: its own value, or all values within the radius."""
    offset, width, radius = part
    masks = F.array(*[F.lit(m).cast("long") for m in _ball(width, radius if ball else 0)])
    own = _value(fingerprint, offset, width)
    return F.transform(masks, lambda m: F.struct(F.lit(number).alias("segment"), own.bitwiseXOR(m).alias("value")))


def _lookups(distinct: DataFrame, parts: list[tuple[int, int, int]], ball: bool) -> DataFrame:
    """segment, value, fingerprint: own values (table), or all values within the radius (look-ups)."""
    rows = [_values(F.col("fingerprint"), i, part, ball) for i, part in enumerate(parts)]
    return distinct.select("fingerprint", F.explode(F.concat(*rows)).alias("_k")).select(
        "_k.segment", "_k.value", "fingerprint"
    )


def links(
    distinct: DataFrame, link_bits: int = LINK_BITS, count: int | None = None, crowded: int = CROWDED
) -> DataFrame:
    """Links (a, b) between distinct fingerprints, enough to connect all that differ in few bits.

    Values with fewer than ``crowded`` entries: every pair at a distance of at most ``link_bits``.
    A value with more may hold most fingerprints, all near to each other, and so a quadratic number of
    pairs. Its members, and those that look it up, instead send the points within half the distance;
    two fingerprints share such a point exactly if they are close enough, and each links to the
    smallest one at the point (see ``_through_points``). That is a fixed number of rows per member, and
    loses no connection.
    """
    if count is None:
        count = best_segments(distinct.count(), link_bits)
    parts = segments(link_bits, count)
    table = _lookups(distinct, parts, ball=False)
    sizes = table.groupBy("segment", "value").agg(F.count("*").alias("n"))
    hot = stage(sizes.where(F.col("n") >= crowded).select("segment", "value"), "simhash-crowded")
    probes = _lookups(distinct, parts, ball=True)
    has_hot = bool(hot.take(1))
    if has_hot:
        few, members = sized(hot), probes.join(sized(hot), ["segment", "value"], "left_semi")
        table = table.join(few, ["segment", "value"], "left_anti")
    left, right = probes.withColumnRenamed("fingerprint", "a"), table.withColumnRenamed("fingerprint", "b")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= link_bits
    same = (left.segment == right.segment) & (left.value == right.value)
    once = (F.col("a") < F.col("b")) & _first_meeting(left.segment, parts)
    found = left.join(right, same & near & once).select("a", "b")
    if has_hot:
        found = found.unionByName(_through_points(members.select("fingerprint").distinct(), link_bits))
    return found


def _first_meeting(segment: Column, parts: list[tuple[int, int, int]]) -> Column:
    """True in the first segment in which a and b are within the radius: a pair that meets in several
    tables is one link."""
    differing = F.col("a").bitwiseXOR(F.col("b"))
    beyond = [F.bit_count(_value(differing, offset, width)) > radius for offset, width, radius in parts]
    first = F.lit(True)
    for i in range(1, len(parts)):
        first = first & ((segment < i) | beyond[i - 1])
    return first


def _points(members: DataFrame, radius: int) -> DataFrame:
    """fingerprint, point: every value within so many bits of each fingerprint, once."""
    points = members.select("fingerprint", F.col("fingerprint").alias("point"), F.lit(0).alias("bit"))
    for _ in range(radius):  # flip one of the bits from ``bit`` on, or, at the last number, none any more
        points = points.select("fingerprint", "point", F.explode(F.expr(f"sequence(bit, {BITS})")).alias("bit"))
        flipped = F.expr(f"IF(bit < {BITS}, point ^ shiftleft(1L, bit), point)")
        points = points.select("fingerprint", flipped.alias("point"), F.least(F.col("bit") + 1, F.lit(BITS)).alias("bit"))
    return points.select("fingerprint", "point")


def _through_points(members: DataFrame, link_bits: int) -> DataFrame:
    """Links of each fingerprint to the smallest one with which it shares a point.

    For an even distance 2h, points within h bits of a fingerprint: shared exactly by those at most 2h
    apart. For an odd distance 2h + 1, each fingerprint sends the points within h bits as its own and
    those at h + 1 bits as a visitor; owners link to the smallest owner, visitors too. Visitors alone
    do not meet, as they may be 2h + 2 apart.
    """
    half, odd = divmod(link_bits, 2)
    points = _points(members, half)
    first = points.groupBy("point").agg(F.min("fingerprint").alias("a"))
    if odd:
        points = _points(members, half + 1)
    return (
        points.join(first, "point")
        .where("a <> fingerprint")
        .select("a", F.col("fingerprint").alias("b"))
        .distinct()
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    link_bits: int = LINK_BITS,
    count: int | None = None,
    crowded: int = CROWDED,
) -> DataFrame:
    """doc_id, fingerprint, component_id (smallest id reachable through links, its own included).

    Documents with one fingerprint are linked and stand as one node from then on, so a text copied any
    number of times costs one look-up. Null and empty texts have fingerprint zero, and so have texts of
    white space only. Rows that repeat an id each give a row with the same component if their texts
    link, else one each. A null id takes part in links but names a component only if all its ids are
    null. An empty table gives no rows. Further columns are ignored.
    """
    prints = stage(fingerprints(docs, id_col, text, shingle_words), "simhash-prints")
    distinct = stage(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    nodes = connected_components(links(distinct.select("fingerprint"), link_bits, count, crowded))
    labelled = distinct.join(nodes, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "first_id", F.coalesce("component", "fingerprint").alias("component")
    )
    labelled = stage(labelled, "simhash-labels")  # stored tables, so that the join can split a large component
    smallest = stage(labelled.groupBy("component").agg(F.min("first_id").alias("component_id")), "simhash-smallest")
    by_print = labelled.join(sized(smallest), "component").select("fingerprint", "component_id")
    by_print = stage(by_print, "simhash-groups")
    return prints.join(sized(by_print), "fingerprint").select("doc_id", "fingerprint", "component_id")


def hex_digits(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows that stay: of every component the one with the smallest id, with all its columns.

    Rows whose id is null stay only if they are alone in their component's ids; of rows that repeat
    the id that stays, all with its fingerprint's component stay as they are one document.
    """
    groups = near_duplicates(docs, id_col, text, **options)
    keep = stage(
        groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__keep")).distinct(),
        "simhash-kept",
    )
    return docs.join(sized(keep), docs[id_col].eqNullSafe(F.col("__keep")), "left_semi")
