"""TF-IDF retrieval straight from a folder of files."""

import os

import models
import pytest

from lectern.plans import texts


@pytest.fixture
def units(spark, folder):
    contents = {
        "long.txt": "Rivers carve stone. " * 90 + "Lanterns glow at night. " * 40,
        "short.TXT": "A lantern by the harbour.",
        "blank.txt": " \n\t ",
        "broken.pdf": "junk",
        "other.log": "not read here",
        "sub/deep.txt": "not read either",
    }
    for name, content in contents.items():
        os.makedirs(os.path.dirname(f"{folder}/{name}"), exist_ok=True)
        with open(f"{folder}/{name}", "w") as file:
            file.write(content)
    return contents, texts.load_units(spark, folder)


def expected_units(contents):
    placeholder = "[PDF file: broken.pdf - Error reading: Unexpected error: no extractor for paged files]"
    kept = {"long.txt": contents["long.txt"], "short.TXT": contents["short.TXT"], "broken.pdf": placeholder}
    made = {}
    for source, text in kept.items():
        cut = models.sentences(text)
        made |= {(source, n): (c, len(cut)) for n, (_, _, c) in enumerate(cut)}
    return made


def test_units(units):
    contents, df = units
    rows = df.collect()
    assert {(r["source"], r["chunk_id"]): (r["content"], r["total_chunks"]) for r in rows} == expected_units(contents)


def test_ask(spark, units):
    contents, df = units
    asked = ["lantern harbour", "rivers stone night", "nothing of this kind"]
    queries = spark.createDataFrame(list(enumerate(asked)), "query_id int, query_text string")
    rows = texts.ask(df, queries, 3).orderBy("query_id", "rank").collect()
    texts_of = {key: content for key, (content, _) in expected_units(contents).items()}
    for n, question in enumerate(asked):
        expected = models.tfidf_top(texts_of, question, 3)
        got = [((r["source"], r["chunk_id"]), round(r["similarity"], 9)) for r in rows if r["query_id"] == n]
        assert got == [(key, pytest.approx(s, abs=2e-9)) for key, s in expected]
    assert all(texts_of[(r["source"], r["chunk_id"])] == r["content"] for r in rows)
