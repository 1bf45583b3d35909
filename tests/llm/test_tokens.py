import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from lectern.llm import token_counts, token_files
from lectern.llm.pieces import Pieces, spelled
from tests.llm import samples

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
TABLE = token_counts.BytePairs(PATH)
ALPHABET = " \n\t\r aaaabcdeéÀñ12.,'<>|!ßstvre　\x1c​中😀\x85 "


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def strange(n=4000):
    rnd = random.Random(3)
    out = ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 50))) for _ in range(n)]
    return out + ["a <|endoftext|> b<|endoftext|>", "a" * 500, "\n\n\n<|endoftext|>", "it's he'll 'sx", " ", "\n", "  "]


def test_counts_equal_the_library():
    texts = strange()
    assert token_counts.batch_counts(TABLE, {}, texts) == [len(ids(t)) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_pieces_are_the_text_and_keep_the_tokens(text):
    pieces = Pieces([text])
    parts = pieces.odd.get(0, pieces.first) + [spelled(pieces.names[n]) for n in pieces.numbers[1:]]
    assert "".join(parts) == text
    assert [i for p in parts for i in ids(p)] == ids(text)
    assert token_counts.batch_counts(TABLE, {}, [text]) == [len(ids(text))]


def test_encoder_equals_the_library(monkeypatch):
    monkeypatch.setattr(token_files, "CACHE_PIECES", 500)
    encoder = token_files._Encoder(PATH, 2)
    texts = strange(2000) + [samples.words(i, 60) for i in range(40)]
    for a in range(0, len(texts), 300):
        part = texts[a : a + 300]
        assert encoder.encode(part) == [np.array(ids(t), "<u2").tobytes() for t in part]


def test_pieces_in_use_are_learnt_once(monkeypatch):
    """Op5, check of round 3: a full cache forgot all that the batch at hand did not hold."""
    monkeypatch.setattr(token_files, "CACHE_PIECES", 40)
    encoder, learnt = token_files._Encoder(PATH, 2), []
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda parts: (learnt.extend(parts), learn(parts)))
    a, b, c = ([f"{letter}{i}" for i in range(n)] for letter, n in (("a", 10), ("b", 15), ("c", 20)))
    for words in (a, b, a, c, a):
        text = " ".join(["x", *words])
        assert encoder.encode([text]) == [np.array(ids(text), "<u2").tobytes()]
        assert len(encoder.known) + len(encoder.older) <= 40 + len(words)
    assert sorted(learnt) == sorted([*a, *b, *c, "x"])


def test_small_caches_change_nothing(monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE_PIECES", 50)
    known = {}
    for a in range(0, 400, 40):
        texts = [samples.words(i, 30) for i in range(a, a + 40)]
        assert token_counts.batch_counts(TABLE, known, texts) == [len(ids(t)) for t in texts]


def test_counts_of_a_table(spark):
    got = sorted(((r.doc_id or -1), r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(samples.documents(spark), PATH).collect())
    want = sorted(((r[0] or -1), len((r[1] or "").encode()), len(ids(r[1])), len(ids(r[1])) > 1024) for r in samples.rows())
    assert got == want
    assert token_counts.token_counts(samples.empty(spark), PATH).count() == 0


@pytest.mark.parametrize("partitions", [1, 4, None])
def test_files_round_trip(spark, folder, partitions):
    docs = samples.documents(spark).repartition(5)
    manifest = token_files.write_token_files(docs, folder, PATH, partitions=partitions)
    rows = sorted(token_files.read_documents(manifest, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted([r[0] for r in samples.rows()], key=lambda i: -1 if i is None else i)
    texts = {}
    for r in samples.rows():
        texts[r[0]] = r[1]
    start = 0
    for row in rows:
        want = [*ids(texts[row.doc_id]), 0]
        assert (row.start, row.n_tokens) == (start, len(want))
        assert row.ids_crc32 == zlib.crc32(struct.pack(f"<{len(want)}I", *want))
        start += len(want)
    # the files themselves: flat 16-bit ids, 64-bit offsets
    for m in manifest.collect():
        offsets = token_files.map_file(folder, m.offsets_file, "<i8")
        assert len(offsets) == m.documents + 1 and offsets[-1] == m.tokens
        assert len(token_files.map_file(folder, m.tokens_file, "<u2")) == m.tokens


def test_no_files_of_an_empty_table(spark, folder):
    manifest = token_files.write_token_files(samples.empty(spark), folder, PATH)
    assert manifest.count() == 0
    assert token_files.read_documents(manifest, folder).count() == 0
