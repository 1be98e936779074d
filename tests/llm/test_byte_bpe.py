"""Tree reduction against the tiktoken library."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from heliopanel.llm import byte_bpe

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def coder():
    return byte_bpe.worker_coder(PATH, P.PATTERN)


@pytest.fixture(scope="module")
def library(coder):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})


def ids(coder, text):
    return np.frombuffer(coder.encode_bytes(text), "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aabbet's'reTHE 0129.,!?\n\t éßñ日本\U0001f600-=#_ ")), max_size=80))
def test_equal_to_library(coder, library, text):
    want = library.encode_ordinary(text)
    assert ids(coder, text) == want
    assert coder.decode(want) == text.encode()


def test_every_token_codes_itself(coder):
    assert all(coder.merge(b) == (i,) for b, i in coder.ranks.items())


def test_long_matches_and_small_leaves(coder, library, monkeypatch):
    r = random.Random(3)
    monkeypatch.setattr(byte_bpe, "LEAF_CHARS", 3)
    monkeypatch.setattr(byte_bpe, "LEAF_TOKENS", 2)
    for _ in range(400):
        text = "".join(r.choice(["the", " ", "  ", "'", "'re", "r", "e", "x9", "\n", "é", "!!", "aaaa", "ing"])
                       for _ in range(r.randint(0, 40)))
        assert ids(coder, text) == library.encode_ordinary(text), text
        assert coder.decode(ids(coder, text)) == text.encode()
    for text in ("a" * 5000, "ab" * 3000, "=" * 4097, "".join(r.choice("abcdeth") for _ in range(6000)), " " * 999 + "x"):
        assert ids(coder, text) == library.encode_ordinary(text)


def test_classes_of_all_characters(coder, library):
    for lo in range(0, 0x11000, 16):
        text = "".join(f"a{chr(c)}1{chr(c)}{chr(c)} b" for c in range(lo, lo + 16) if not 0xD800 <= c < 0xE000)
        assert ids(coder, text) == library.encode_ordinary(text), hex(lo)


def test_operator_edges(spark, coder, library):
    long = "the cat's  " * 40_000
    rows = [(1, None, 5), (2, "", 5), (3, "Hello  wörld's", 5), (3, "Hello  wörld's", 5), (4, long, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted(map(tuple, byte_bpe.round_trip(docs, PATH, P.PATTERN).collect()))
    for (i, n, a, b), (_, text, _) in zip(got, rows):
        want = library.encode_ordinary(text or "")
        assert n == len(want) and a == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert b == hashlib.sha256((text or "").encode()).hexdigest()
    back = byte_bpe.decode(byte_bpe.encode(docs, PATH, P.PATTERN), PATH, P.PATTERN).collect()
    assert sorted((r[0], bytes(r[1])) for r in back) == sorted((i, (t or "").encode()) for i, t, _ in rows)
    assert byte_bpe.round_trip(docs.limit(0), PATH, P.PATTERN).count() == 0
