import math
import random

import models
import numpy as np
import pytest

from lectern.operators import tfidf


def units(spark, texts):
    return spark.createDataFrame(list(texts.items()), "key long, text string").repartition(3)


def questions(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "query_id int, query_text string")


def corpus(count=60, seed=3):
    """One word is in every text, one in a third of them, most are rare; some texts are copies."""
    rnd = random.Random(seed)
    texts = {}
    for key in range(count):
        bag = ["the"] + (["third"] * rnd.randint(1, 3) if key % 3 == 0 else [])
        bag += [f"w{rnd.randrange(80)}" for _ in range(rnd.randint(1, 20))]
        texts[key] = texts[key - 1] if key % 10 == 9 else " ".join(bag)
    return texts


def ranked(df):
    found = {}
    for row in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(row["query_id"], []).append((row["key"], round(row["similarity"], 9)))
        assert row["rank"] == len(found[row["query_id"]])
    return found


def test_idf_values(spark):
    scores = tfidf.inverse_document_frequency(units(spark, {1: "a b", 2: "a b c", 3: "a"}))
    values = {r["token"]: (r["df"], r["idf"]) for r in scores.collect()}
    assert values["a"] == (3, pytest.approx(math.log(3 / 4)))
    assert values["b"] == (2, 0.0)
    assert values["c"] == (1, pytest.approx(math.log(3 / 2)))


def test_terms_counted_without_shuffle(spark):
    df = spark.createDataFrame([(1, "b a b"), (2, ""), (3, "...")], "key long, text string")
    terms = tfidf.term_frequency(df, ["key"])
    assert sorted(map(tuple, terms.select("key", "token", "count", "total_tokens").collect())) == [
        (1, "a", 1, 3), (1, "b", 2, 3),
    ]
    assert "Exchange" not in terms._jdf.queryExecution().executedPlan().toString()


def test_unknown_tokens_count_in_the_total(spark):
    idf = tfidf.inverse_document_frequency(units(spark, {1: "a b", 2: "c"}))
    rows = tfidf.weights(tfidf.term_frequency(units(spark, {9: "a zzz yyy zzz"}), ["key"]), idf, ["key"]).collect()
    assert [(r["token"], r["weight"]) for r in rows] == [("a", pytest.approx(0.25 * math.log(2 / 2)))]


QUESTIONS = ["third w1 w2", "the", "w5 w5 w6 unknownword", "nothing known", "", "w10 third third the"]


@pytest.mark.parametrize("k", [1, 5, 100])
def test_top_k_against_model(spark, k):
    texts = corpus()
    found = ranked(tfidf.search(units(spark, texts), questions(spark, *QUESTIONS), ["key"], k))
    for query_id, text in enumerate(QUESTIONS):
        expected = [(key, pytest.approx(s, abs=2e-9)) for key, s in models.tfidf_top(texts, text, k)]
        assert found.get(query_id, []) == expected


@pytest.mark.parametrize("rows", [0, 1, 10, 40])
def test_vocabulary_beyond_the_bound_gives_the_same(spark, rows):
    texts = corpus(150)
    df, asked = units(spark, texts), questions(spark, *QUESTIONS)
    plain = ranked(tfidf.search(df, asked, ["key"], 7))
    assert ranked(tfidf.search(df, asked, ["key"], 7, broadcast_rows=rows)) == plain
    idf = tfidf.inverse_document_frequency(df)
    terms = tfidf.term_frequency(df, ["key"])

    def weighted(bound):
        rows_ = tfidf.weights(terms, idf, ["key"], bound).collect()
        return sorted((r["key"], r["token"], round(r["weight"], 12)) for r in rows_)

    assert weighted(rows) == weighted(10_000)


def test_stored_index_agrees(spark):
    df, asked = units(spark, corpus(150)), questions(spark, *QUESTIONS)
    plain = ranked(tfidf.search(df, asked, ["key"], 7))
    assert ranked(tfidf.search_index(tfidf.build_index(df, ["key"]), asked, 7)) == plain


def test_frequent_tokens_are_few_and_rare_ones_rare(spark):
    texts = {key: f"hot {'warm' if key % 2 else ''} rare{key} pair{key // 2}" for key in range(300)}
    idf = tfidf.inverse_document_frequency(units(spark, texts))
    frequent, rare = tfidf.split_vocabulary(idf, rows=10)
    assert {r["token"] for r in frequent.collect()} == {"hot", "warm"}
    assert rare.count() == 450 and rare.agg({"df": "max"}).first()[0] == 2
    everything, nothing = tfidf.split_vocabulary(idf, rows=452)
    assert everything.count() == 452 and nothing is None


def test_units_without_known_tokens_have_no_vector(spark):
    idf = tfidf.inverse_document_frequency(units(spark, {1: "a b", 2: "c"}))
    strange = units(spark, {7: "zzz", 8: "a zzz", 9: ""})
    for rows in (0, 2, 100):
        found = tfidf.vectors(strange, idf, ["key"], broadcast_rows=rows).collect()
        assert [(r["key"], [t["token"] for t in r["terms"]]) for r in found] == [(8, ["a"])]


def test_ties_favour_the_later_unit(spark):
    texts = {1: "x y", 2: "x y", 3: "x y", 4: "z", 5: "q"}
    found = ranked(tfidf.search(units(spark, texts), questions(spark, "x"), ["key"], 2))
    assert [key for key, _ in found[0]] == [3, 2]


def test_vocabulary(spark):
    rows = tfidf.vocabulary(units(spark, {1: "b A c", 2: "é a 1"})).collect()
    assert [t for _, t in sorted((r["token_index"], r["token"]) for r in rows)] == ["1", "a", "b", "c", "é"]


# ---- scoring in place ----------------------------------------------------------------------------


def _texts(seed, n, words, length):
    rnd = random.Random(seed)
    common = [f"common{i}" for i in range(8)]
    return [" ".join(rnd.choices(common, k=length) + [f"rare{rnd.randrange(words)}" for _ in range(3)]) for _ in range(n)]


def test_in_place_equals_the_join_on_ties_and_copies(spark, monkeypatch):
    texts = _texts(1, 300, 60, 9) + ["alpha beta gamma"] * 150 + ["everywhere"] + ["", "?!"]
    texts = [f"everywhere {t}" if t else t for t in texts]  # a word in nearly every unit: its weight is below zero
    units = spark.createDataFrame(list(enumerate(texts)), "unit long, text string").repartition(3)
    asked = ["alpha gamma", "common1 rare5 rare6", "everywhere", "nowhere", "", "rare1 common2 common2 alpha", "rare7"]
    queries = spark.createDataFrame(list(enumerate(asked)), "query_id long, query_text string")
    found = {}
    index = tfidf.build_index(units, ["unit"])
    for inside in (True, False):
        monkeypatch.setattr(tfidf, "fits", lambda df, inside=inside: inside)
        rows = tfidf.search_index(index, queries, 4).collect()
        found[inside] = sorted((r["query_id"], r["rank"], r["unit"], round(r["similarity"], 9)) for r in rows)
    assert found[True] == found[False]
    assert [u for q, _, u, _ in found[True] if q == 0] == [449, 448, 447, 446]


def test_blocks_score_few_of_all_pairs():
    rnd = np.random.default_rng(3)
    tokens, units, queries, k = 120, 6000, 20, 5
    frequency = 1.0 / np.arange(1, tokens + 1)
    weight_of = np.log(1.0 / frequency) + 0.1
    rows, cols = np.nonzero(rnd.random((units, tokens)) < np.minimum(0.9, frequency * 3))
    matrix = np.zeros((units, tokens))
    matrix[rows, cols] = weight_of[cols] * rnd.integers(1, 4, len(rows))
    norm = np.sqrt((matrix**2).sum(axis=1))
    matrix = matrix[norm > 0] / norm[norm > 0][:, None]
    asked = np.zeros((queries, tokens))
    for q in range(queries):
        chosen = np.r_[rnd.choice(8, 4, replace=False), rnd.choice(np.arange(8, tokens), 4, replace=False)]
        asked[q, chosen] = weight_of[chosen]
    asked /= np.sqrt((asked**2).sum(axis=1))[:, None]
    q, t = np.nonzero(asked)
    terms = tfidf.QueryTerms(q, t, asked[q, t], k)
    got = []
    for a in range(0, len(matrix), 500):
        part = matrix[a : a + 500][:, terms.tokens]
        r, c = np.nonzero(part)
        row, query, similarity = terms.score(r, c, part[r, c])
        got += zip(query.tolist(), (row + a).tolist(), similarity.tolist(), strict=True)
    whole = matrix @ asked.T
    for query in range(queries):
        mine = sorted(((-round(s, 9), -u) for o, u, s in got if o == query))[:k]
        want = sorted((-round(s, 9), -u) for u, s in enumerate(whole[:, query].tolist()))[:k]
        assert mine == want
    assert terms.pairs < 0.4 * (whole > 0).sum()


def test_long_tokens_are_not_broadcast(spark, monkeypatch):
    idf = spark.createDataFrame([("a", 5, 0.1), ("b" * 1000, 9, 0.2), ("c", 2, 0.3)], "token string, df long, idf double")
    assert tfidf.split_vocabulary(idf)[1] is None  # few bytes in all
    frequent, rare = tfidf.split_vocabulary(idf, size=500)
    assert sorted(r["token"] for r in frequent.collect()) == ["a", "c"]
    assert [r["df"] for r in rare.collect()] == [9]
    split = tfidf.split_vocabulary
    monkeypatch.setattr(tfidf, "split_vocabulary", lambda idf, rows=10: split(idf, rows, size=100))
    units = spark.createDataFrame([(1, "a a " + "x" * 300), (2, "x" * 300 + " c"), (3, "a q")], "unit long, text string")
    queries = spark.createDataFrame([(1, "x" * 300)], "query_id long, query_text string")
    assert [r["unit"] for r in tfidf.search(units, queries, ["unit"], 5).orderBy("rank").collect()] == []  # in all but one
    more = units.unionByName(spark.createDataFrame([(4, "d e"), (5, "f")], "unit long, text string"))
    assert [r["unit"] for r in tfidf.search(more, queries, ["unit"], 5).orderBy("rank").collect()] == [2, 1]


def test_merged_counts_are_those_of_a_new_fit(spark):
    old = {i: f"common word{i % 7} only{i}" for i in range(30)}
    new = {i: (f"common word{i % 5} fresh{i}" if i % 3 == 0 else old.get(i, f"late{i} common")) for i in range(5, 40)}
    table = lambda texts: spark.createDataFrame(list(texts.items()), "unit long, text string")
    counts = tfidf.token_counts(table(old))
    arriving = {i: t for i, t in new.items() if old.get(i) != t}
    leaving = {i: t for i, t in old.items() if new.get(i) != t}
    merged = tfidf.fitted(tfidf.merged_counts(counts, table(arriving), table(leaving)))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, tfidf.inverse_document_frequency(table(new)).collect()))
    with pytest.raises(ValueError):
        tfidf.merged_counts(counts, table({90: "x"}), table({91: "never seen"}))
