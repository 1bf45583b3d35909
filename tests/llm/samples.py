"""Small tables with the cases that every operator must stand: nulls, empty and long texts, copies,
repeated rows, and columns whose names the operators use themselves."""

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "kept boolean, score double, rank int, _length int, _text string, block int, stream int, fingerprint string"
)
EXTRA = (True, 0.5, 1, 7, "clash", 3, 4, "f")


def words(seed, n, vocabulary=400):
    rnd = random.Random(seed)
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n))


def rows():
    long_text = words(1, 30_000, 5_000)
    base = words(2, 120)
    texts = [
        (1, base, "en", "a"),
        (2, base.upper(), "en", "a"),
        (3, base + " tail", "en", "b"),
        (4, None, None, None),
        (5, "", "de", "b"),
        (6, " \n\t ", "de", ""),
        (7, long_text, "fr", "a"),
        (8, long_text, "fr", "b"),
        (9, words(3, 80), "en", "a"),
        (9, words(3, 80), "en", "a"),
        (10, "ÉCOLE école Éa", "fr", "a"),
        (11, "école École éa", None, "c"),
        (None, words(4, 50), "en", "a"),
        (12, "one two", "en", None),
        (13, words(5, 300), "en", "a"),
    ]
    return [(i, t, lang, s, None if t is None else len(t), *EXTRA) for i, t, lang, s in texts]


def documents(spark, count=None):
    return spark.createDataFrame(rows()[:count], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def simple(spark, pairs, partitions=3):
    return spark.createDataFrame(pairs, "doc_id long, text string").repartition(partitions)


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
