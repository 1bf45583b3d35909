import random
from itertools import combinations

import pytest
import xxhash
from pyspark.sql import functions as F

from lectern.llm import simhash as op
from lectern.llm.components import connected_components
from tests.llm import samples


def fingerprint(text, n=op.SHINGLE_WORDS):
    tokens = [w for w in samples.lower(text).replace("\t", " ").replace("\n", " ").split(" ") if w]
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i : i + n]) for i in range(max(1, len(tokens) - n + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


@pytest.mark.parametrize("link_bits,count,crowded", [(4, None, 512), (4, 2, 512), (4, 4, 512), (4, 3, 2), (3, None, 2), (6, 4, 512), (6, None, 3), (1, None, 512), (0, None, 512)])
def test_links_connect_what_is_near(spark, link_bits, count, crowded):
    rnd = random.Random(link_bits)
    values = set()
    for _ in range(6):
        value = rnd.getrandbits(64)
        for _ in range(12):
            values.add(value)
            value ^= sum(1 << b for b in rnd.sample(range(64), rnd.randint(1, 7)))
    near = [(a, b) for a, b in combinations(sorted(values), 2) if (a ^ b).bit_count() <= link_bits]
    df = spark.createDataFrame([(signed(v),) for v in values], "fingerprint long")
    found = [(r.a % (1 << 64), r.b % (1 << 64)) for r in op.links(df, link_bits, count, crowded).collect()]
    assert all((a ^ b).bit_count() <= link_bits for a, b in found)
    assert components(values, found) == components(values, near)
    if crowded == 512:
        assert {tuple(sorted(p)) for p in found} == {tuple(sorted(p)) for p in near}


def test_groups_against_brute_force(spark):
    rnd = random.Random(5)
    texts = [t for *_, t in [(r[0], r[1]) for r in samples.rows()]]
    base = samples.words(6, 400).split()
    for _ in range(30):
        edited = list(base)
        for _ in range(rnd.randint(0, 3)):
            edited[rnd.randrange(len(edited))] = f"x{rnd.randrange(99)}"
        texts.append(" ".join(edited))
    docs = samples.simple(spark, list(enumerate(texts)))
    prints = {i: fingerprint(t) for i, t in enumerate(texts)}
    near = [(a, b) for a, b in combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 4]
    want = components(prints, near)
    for crowded in (512, 3):
        rows = op.near_duplicates(docs, crowded=crowded).withColumn("hex", op.hex_digits(F.col("fingerprint"))).collect()
        assert {r.doc_id: r.hex for r in rows} == {i: f"{p:016x}" for i, p in prints.items()}
        assert {r.doc_id: r.component_id for r in rows} == want
        assert len(rows) == len(texts)


def test_odd_rows(spark):
    docs = samples.documents(spark)
    rows = op.near_duplicates(docs).collect()
    assert len(rows) == len(samples.rows())
    by_id = {r.doc_id: r for r in rows}
    assert by_id[2].component_id == 1 and by_id[8].component_id == 7 and by_id[6].component_id == 4
    assert by_id[None].component_id is None
    kept = op.one_per_group(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id or -1) for r in kept.collect())
    assert set(ids) == {r.component_id or -1 for r in rows}
    assert op.near_duplicates(samples.empty(spark)).count() == 0
    assert op.one_per_group(samples.empty(spark)).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(1000, 1200)]
    loop = [(3, 3), (5, 4), (4, 5)]
    df = spark.createDataFrame(path + star + loop, "a long, b long").repartition(4)
    got = {r.node: r.component for r in connected_components(df).collect()}
    want = components({x for p in path + star + loop for x in p} - {3}, [p for p in path + star + loop if p[0] != p[1]])
    assert got == want
