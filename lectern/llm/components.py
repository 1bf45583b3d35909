"""Connected components of a table of links, by rounds of small joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lectern.operators.rows import sized
from lectern.session import stage


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (its smallest node): one row per node that has a link.

    Alternates two steps until nothing changes: every node links its larger neighbours to its smallest
    one (large star), then its smaller neighbours likewise (small star). Both keep the components; the
    links end as stars around the smallest nodes, after a number of rounds that grows with the
    logarithm of the longest path. A round is two aggregations with partial minima and joins back to
    the links. The minima are stored first, so that a join meets plain tables and adaptive execution can
    split the links of a node with very many neighbours. Each round is written to the shared folder.
    """
    edges = stage(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "links"
    )
    rounds = 0
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"links-least-{rounds}")
        large = both.where("v > u").join(sized(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large.where("u <> v"), f"links-large-{rounds}")
        least = stage(large.groupBy("u").agg(F.min("v").alias("m")), f"links-least-{rounds}")
        pairs = large.join(sized(least), "u")
        small = (
            pairs.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(pairs.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
        following = stage(small, f"links-small-{rounds}")
        rounds += 1
        before, after = _digest(edges), _digest(following)
        edges = following
        if before == after:
            break
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )


def _digest(edges: DataFrame) -> tuple:
    """Tells two sets of links apart: their number and two sums of hashes."""
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.bit_xor(h), F.sum(h.cast("decimal(20,0)"))).first())
