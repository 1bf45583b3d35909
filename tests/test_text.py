import hashlib
import random

import models
import pytest
from pyspark.sql import functions as F

from lectern.functions import ids, text as tx


def apply(spark, column, values):
    df = spark.createDataFrame(list(enumerate(values)), "n int, text string")
    return [row["out"] for row in df.select("n", column.alias("out")).orderBy("n").collect()]


NOISE = list("ab.Z9_ \t\n\r") + [
    " ", " ", " ", "　", "​", "﻿", "", "\x00", "\x1c", "\x85", "\x9f",
    "é", "é", "\U0001f600", "\x0b", "\x0c",
]


def noisy(count, seed, longest=40):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(NOISE) for _ in range(rnd.randrange(longest))) for _ in range(count)]


def test_normalize_cases(spark):
    cases = {
        "Multiple   spaces   between   words": "Multiple spaces between words",
        "Line 1\n\n\n\nLine 2": "Line 1\nLine 2",
        "  Leading and trailing spaces  \n\n  Another line  ": "Leading and trailing spaces\nAnother line",
        "": "",
        None: "",
        "a b": "ab",
        "a　b": "ab",
        "a​b": "ab",
        "﻿x": "x",
    }
    assert apply(spark, tx.normalize_text("text"), cases) == list(cases.values())


def test_normalize_against_model_and_idempotent(spark):
    texts = noisy(3000, 1)
    clean = apply(spark, tx.normalize_text("text"), texts)
    assert clean == [models.normalize(t) for t in texts]
    assert apply(spark, tx.normalize_text("text"), clean) == clean


def test_blank_and_strip(spark):
    texts = noisy(500, 2, 6) + ["", " \n\t ", "\x1c　"]
    assert apply(spark, tx.is_blank("text"), texts) == [not t.strip() for t in texts]
    assert apply(spark, tx.strip("text"), texts) == [t.strip() for t in texts]


def test_token_counts(spark):
    sentence = "This is a longer text with many words to test the token counting functionality"
    assert apply(spark, tx.token_count("text"), ["This is a test", "", None, sentence]) == [5, 0, 0, 18]
    texts = noisy(500, 3)
    assert apply(spark, tx.token_count("text"), texts) == [int(len(t.split()) * 1.3) for t in texts]


def test_tokens(spark):
    texts = ["Hello, World_1! it's Été 你好 x²", "", "...", "A-b a--B"]
    assert apply(spark, tx.tokens("text"), texts) == [models.words(t) for t in texts]


def test_hash(spark):
    texts = ["", "abc", "é\U0001f600"]
    assert apply(spark, tx.content_hash("text"), texts) == [hashlib.sha256(t.encode()).hexdigest() for t in texts]


@pytest.mark.parametrize(
    "path, kind",
    [("/d/b.TXT", "txt"), ("/d.x/noext", ""), ("/d/.hidden", ""), ("a.tar.gz", "gz"), ("a.", ""), ("/x/c.md", "md")],
)
def test_file_type(spark, path, kind):
    assert apply(spark, tx.file_type("text"), [path]) == [kind]


def test_preview(spark):
    assert apply(spark, tx.preview("text", 3), ["abc", "abcd"]) == ["abc", "abc..."]
    assert apply(spark, tx.preview("text", 3, always_mark=True), ["abc", "abcd"]) == ["abc...", "abc..."]


def test_ids(spark):
    made = apply(spark, ids.document_id("text", F.lit("h")), ["a", "b", "a"])
    assert made[0] == made[2] != made[1]
    assert all(len(i) == 36 and i.count("-") == 4 for i in made)
    assert apply(spark, ids.stable_id("text", F.lit("c")), ["ab"]) != apply(
        spark, ids.stable_id("text", F.lit("bc")), ["a"]
    )
