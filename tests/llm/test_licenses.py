import re

from lectern.llm import licenses as op
from tests.llm import samples


def brute(text, threshold=op.THRESHOLD, size=op.BLOCK_WORDS):
    words = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", samples.lower(text)) if w]
    places, base = [], set()
    for phrase, label in op.PHRASES.items():
        parts = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        places += at
        base |= {label} if at else set()
    labels, best = set(base), 0.0
    for start in range(0, max(1, len(words)), size // 2):
        block = set(words[start : start + size])
        for label, template in op.TEMPLATES:
            t = set(op._plain_words(template))
            share = len(block & t) / len(t)
            if share >= threshold - 1e-9:
                labels.add(label)
                best = max(best, share)
    score = 1.0 if places else best
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), score)


def texts():
    filler = samples.words(8, 150)
    mit = dict(op.TEMPLATES[::-1])["mit"]
    long_mit = [t for label, t in op.TEMPLATES if label == "mit"][1]
    return [
        filler,
        f"{filler} {op.TEMPLATES[1][1]} {filler}",
        f"{filler}\n{long_mit.upper()}\n{filler} {filler}",
        f"{samples.words(9, 70)} {long_mit} {mit}",
        " ".join(long_mit.split()[2:]),  # some words short of the template
        " ".join(long_mit.split()[5:]),
        "GNU General\nPublic-License gnu general public license. Apache, License; CC BY 4.0 and MIT  License",
        "cc by cc by cc",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "license public general gnu", "mitlicense mit licenses", "", None, " .,;", "É mit license é", "的mit license",
    ]


def columns(row):
    return (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels, row.labels, round(row.score, 9))


def test_against_brute_force(spark):
    docs = samples.simple(spark, list(enumerate(texts())))
    got = {r.doc_id: columns(r) for r in op.scan_licenses(docs).collect()}
    want = {i: (*brute(t)[:-1], round(brute(t)[-1], 9)) for i, t in enumerate(texts())}
    assert got == want
    assert any("mit" in w[5] and "mit" not in w[4] for w in want.values())  # found by the join alone


def test_whole_license_texts(spark):
    """Each has its own label only, wherever it stands; so has any one of its passages."""
    filler = samples.words(5, 101)
    whole = [(label, f"{filler} {text} {filler}") for label, text in op.WHOLE_TEXTS]
    parts = [(label, f"{filler} {t}") for label, t in op.passages(op.WHOLE_TEXTS)]
    docs = samples.simple(spark, list(enumerate(t for _, t in whole + parts)))
    got = {r.doc_id: columns(r) for r in op.scan_licenses(docs).collect()}
    assert [got[i][5] for i in range(len(got))] == [label for label, _ in whole + parts]
    assert all(got[i][:5] == brute(t)[:5] for i, (_, t) in enumerate(whole + parts))


def test_passages_are_cut_evenly():
    assert op.passages([("a", "w " * 97), ("b", " ., "), ("c", "one two")], 48) == [
        ("a", " ".join(["w"] * 32)), ("a", " ".join(["w"] * 32)), ("a", " ".join(["w"] * 33)), ("c", "one two"),
    ]


def test_odd_rows(spark):
    got = sorted((r.doc_id or -1, r.n_words, r.labels) for r in op.scan_licenses(samples.documents(spark)).collect())
    assert got == sorted((r[0] or -1, brute(r[1])[0], "") for r in samples.rows())
    assert op.scan_licenses(samples.empty(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = op.scan_licenses(samples.documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
