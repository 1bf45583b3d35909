"""Plain Python models of the per-text functions, written independently of the library."""

import math
import re


def normalize(text):
    kept = "".join(c for c in text or "" if c.isprintable() or c in "\n\t")
    lines = (" ".join(line.split()) for line in kept.split("\n"))
    return "\n".join(line for line in lines if line)


def fixed(text, size, overlap):
    step = size - overlap if overlap < size else size
    count = 0 if not text else 1 if len(text) <= size else 1 + math.ceil((len(text) - size) / step)
    spans = [(i * step, min(i * step + size, len(text))) for i in range(count)]
    return [(a, b, text[a:b]) for a, b in spans if text[a:b].strip()]


def sentences(text, size=1000, overlap=100):
    if not text.strip():
        return []
    if len(text) <= size:
        return [(0, len(text), text)]
    spans, start = [], 0
    while start < len(text):
        stop = start + size
        if stop < len(text):
            first = max(stop - 200, start) + 1
            ends = [p for p in range(first, stop + 1) if text[p] in ".!?"]
            stop = ends[-1] + 1 if ends else stop
        spans.append((start, min(stop, len(text))))
        start = stop - overlap
    return [(a, b, text[a:b].strip()) for a, b in spans if text[a:b].strip()]


def words(text):
    return re.findall(r"\w+", text.lower())


def tfidf_top(units, question, k):
    """[(key, similarity)] of the k units most similar to the question; units maps key to text."""
    bags = {key: words(text) for key, text in units.items()}
    idf = {}
    for token in {t for bag in bags.values() for t in bag}:
        idf[token] = math.log(len(bags) / (sum(token in bag for bag in bags.values()) + 1))

    def vector(bag):
        return {t: bag.count(t) / len(bag) * idf[t] for t in set(bag) if t in idf}

    def norm(v):
        return math.sqrt(sum(x * x for x in v.values()))

    asked = vector(words(question))
    scored = []
    for key, bag in bags.items():
        v = vector(bag)
        if norm(v) and norm(asked):
            dot = sum(v[t] * asked[t] for t in v.keys() & asked.keys())
            scored.append((round(dot / norm(v) / norm(asked), 9), key))
    return [(key, s) for s, key in sorted(scored, reverse=True)[:k] if s > 0]
