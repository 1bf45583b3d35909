import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from lectern.llm import bpe_codec as op
from tests.llm import samples

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
LIBRARY = tiktoken.Encoding("test", pat_str=PATTERN, mergeable_ranks=op.read_ranks(PATH), special_tokens={})
CODEC = op.Codec(PATH, PATTERN)


def sha(data):
    return hashlib.sha256(data).hexdigest()


def expected(text):
    ids = LIBRARY.encode_ordinary(text or "")
    data = b"".join(LIBRARY.decode_single_token_bytes(i) for i in ids)
    assert data == (text or "").encode()
    return len(ids), sha(np.array(ids, "<u4").tobytes()), sha(data)


@pytest.mark.parametrize("long", [op.LONG, 3])
def test_round_trip_of_all_rows(spark, long):
    docs = samples.documents(spark)
    got = [tuple(r) for r in op.round_trip_digests(docs, PATH, PATTERN, long=long).collect()]
    want = [(i, *expected(t)) for i, t, *_ in samples.rows()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_ids_as_the_same_vocabulary_in_the_other_library(spark):
    docs = samples.documents(spark)
    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {i: t or "" for i, t, *_ in samples.rows()}
    for row in op.encode(docs, PATH, PATTERN).collect():
        assert row.ids == other.encode(texts[row.doc_id], add_special_tokens=False).ids


def test_encode_then_decode(spark):
    docs = samples.documents(spark)
    back = op.decode(op.encode(docs, PATH, PATTERN, long=50), PATH, PATTERN)
    got = sorted(((r.doc_id or -1), bytes(r.content)) for r in back.collect())
    assert got == sorted(((i or -1), (t or "").encode()) for i, t, *_ in samples.rows())


def test_part_of_a_character_decodes_to_its_bytes(spark):
    ids = LIBRARY.encode_ordinary("𝄞")
    assert len(ids) > 1
    table = spark.createDataFrame([(1, ids[:1]), (2, None), (3, [])], "doc_id long, ids array<long>")
    got = {r.doc_id: bytes(r.content) for r in op.decode(table, PATH, PATTERN).collect()}
    assert got == {1: LIBRARY.decode_single_token_bytes(ids[0]), 2: b"", 3: b""} and "𝄞".encode().startswith(got[1])


def test_empty_table(spark):
    docs = samples.empty(spark)
    assert op.encode(docs, PATH, PATTERN).count() == 0
    assert op.round_trip_digests(docs, PATH, PATTERN).count() == 0


def test_special_strings_are_ordinary_text():
    assert CODEC.encode("a<|endoftext|>b").tolist() == LIBRARY.encode_ordinary("a<|endoftext|>b")
    assert len(CODEC.encode("<|endoftext|>")) > 1


ODD = ["a", "Z", "7", "'s", "'ll", "'", " ", "  ", "\n", "\t", " ", "　", "é", "日", "本", "。", "かな", ".", "!?", "𝄞", "́", "ß", "x1y2", "<|endoftext|>", " ", "\x85", "\x1c"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(ODD), max_size=40), st.integers(1, 12))
def test_cuts_change_no_ids(parts, long):
    text = "".join(parts)
    assert "".join(op.safe_parts(text, long)) == text
    assert CODEC.encode(text, long).tolist() == LIBRARY.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80), st.integers(1, 9))
def test_any_text(text, long):
    assert CODEC.encode(text, long).tolist() == LIBRARY.encode_ordinary(text)
    assert CODEC.decode(CODEC.encode(text, long)) == text.encode()


def test_very_long_texts():
    rnd = random.Random(3)
    for text in (
        "word and 日本語。 " * 60_000,
        "".join(rnd.choices("abcdefghij", k=400_000)),  # one pre-token
        "a1" * 200_000,
        " " * 100_000 + "x",
    ):
        ids = CODEC.encode(text)
        assert ids.tolist() == LIBRARY.encode_ordinary(text)
        assert CODEC.decode(ids) == text.encode()
    assert max(map(len, op.safe_parts("word and 日本語。 " * 60_000))) < op.LONG + 20
