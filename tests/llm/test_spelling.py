import random
import re
import zlib
from collections import Counter

import pytest

from lectern.llm import spelling as op
from tests.llm import samples


def slipped(rows, every):
    out = []
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = samples.lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out.append(run)
    return out


def near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(counts, ratio=2):
    forms, rows = {}, {}
    for word, n in counts.items():
        met = [(-m, other) for other, m in counts.items() if near(word, other)]
        best = min(met, default=None)
        ok = best is not None and -best[0] >= ratio * n
        forms[word] = best[1] if ok else None
        rows[word] = (n, len(met), -best[0] if ok else None)
    out = []
    for word in counts:
        root = word
        while forms[root] is not None:
            root = forms[root]
        out.append((word, forms[word], root, *rows[word]))
    return sorted(out, key=repr)


def words_table(spark, counts):
    rows = [(w, n, "stem", True, 4) for w, n in counts.items()]
    return spark.createDataFrame(rows, "word string, n int, stem string, once boolean, root int").repartition(3)


def result(words, **options):
    return sorted(map(tuple, op.group_variants(words, **options).collect()), key=repr)


@pytest.mark.parametrize("every", [op.SLIP_EVERY, 3])
def test_words_of_texts(spark, every):
    rows = [(r[0], r[1]) for r in samples.rows()] + [(50, "Straße naïve×café÷ÀÉÿ_x9y a A bb"), (51, "x" * 50_000 + " " + "abcdef " * 5_000)]
    docs = samples.simple(spark, rows)
    got = Counter(r.word for r in op.slipped_words(docs, every=every).collect())
    assert got == Counter(slipped(rows, every))
    counted = {r.word: r.n for r in op.count_words(op.slipped_words(docs, every=every), 2, 2).collect()}
    assert counted == {w: n for w, n in Counter(slipped(rows, every)).items() if len(w) >= 2 and n >= 2}


@pytest.mark.parametrize("seed,letters", [(1, "ab"), (2, "abcé"), (3, "aÿ")])
def test_against_brute_force(spark, seed, letters):
    rnd = random.Random(seed)
    words = {"".join(rnd.choices(letters, k=rnd.randint(1, 7))) for _ in range(160)}
    counts = {w: rnd.choice([1, 2, 3, 3, 6, 12, 50, 400]) for w in sorted(words)}
    assert result(words_table(spark, counts)) == brute(counts)


def test_runs_of_equal_characters_meet_once(spark):
    counts = {"hello": 40, "helo": 5, "helllo": 8, "hellllo": 2, "aaaaa": 9, "aaaa": 4, "aaaaaa": 30}
    got = {r[0]: r for r in result(words_table(spark, counts))}
    assert sorted(got.values(), key=repr) == brute(counts)
    assert got["helo"][1:3] == ("hello", "hello") and got["helo"][4] == 1 and got["helllo"][4] == 2


def test_long_paths_of_forms(spark):
    base = "abcdefghijklmnop"
    counts = {base[: 5 + i]: 3 * 2**i for i in range(12)}
    got = result(words_table(spark, counts))
    assert got == brute(counts)
    assert {r[2] for r in got} == {base}


def test_one_word_near_to_most(spark):
    """A word in the middle of all others: each stem's group stays within the alphabet."""
    letters = [chr(c) for c in range(0xC0, 0x100)] + list("abcdefghijklmnopqrstuvwxyz")
    counts = {"qqqqqq": 100_000}
    for i in range(6):
        counts |= {"qqqqqq"[:i] + c + "qqqqqq"[i + 1 :]: 3 + i for c in letters if c != "q"}
    got = result(words_table(spark, counts))
    assert got == brute(counts)
    assert max(g["count"] for g in op.rotations(words_table(spark, counts)).groupBy("stem").count().collect()) <= len(letters) + 1


def test_ties_and_ratio(spark):
    counts = {"cat": 4, "cut": 8, "cot": 8, "bat": 8, "dog": 1}
    assert result(words_table(spark, counts)) == brute(counts)
    assert result(words_table(spark, counts), ratio=3) == brute(counts, 3)
    with pytest.raises(ValueError):
        op.group_variants(words_table(spark, counts), ratio=1)


def test_nulls_and_empty_tables(spark):
    none = samples.empty(spark)
    assert op.count_words(op.slipped_words(none)).count() == 0
    assert result(op.count_words(op.slipped_words(none))) == []
    words = spark.createDataFrame([(None, 3), ("", 2), ("a", 9)], "word string, n long")
    assert result(words) == brute({"": 2, "a": 9})
