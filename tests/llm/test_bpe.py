import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tilespark.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def transducer():
    return bpe.Transducer(bpe.read_ranks(PATH))


def test_tokens_encode_as_themselves(transducer):
    for rank in range(0, 50_000, 37):
        assert transducer.encode(transducer.bytes_of[rank]) == [rank]


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_equals_the_library(reference, text):
    ids = b"".join(bpe.encode_texts([text], PATH, P.PATTERN))
    assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)


@given(st.lists(st.sampled_from([" ", "  ", "\n", "\t", "\u00a0", "\u3000", "\x1c", "a", "bc", "12", "'s", "!", "é", "the", "\u200b"]), max_size=30))
@settings(max_examples=400, deadline=None)
def test_white_space_of_all_kinds(reference, parts):
    text = "".join(parts)
    ids = b"".join(bpe.encode_texts([text], PATH, P.PATTERN))
    assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)


def test_long_and_repetitive_pieces(reference, transducer):
    rng = random.Random(0)
    for piece in ("a" * 3000, "ab" * 700, "".join(rng.choice("abcdefghij") for _ in range(2000)), "é" * 500, " " * 999):
        assert [t for p in regex.findall(P.PATTERN, piece) for t in transducer.encode(p.encode())] == reference.encode_ordinary(piece)


def test_caches_may_empty_at_any_time(reference, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_PIECES", 3)
    monkeypatch.setattr(bpe, "CACHED_STATES", 5)
    monkeypatch.setattr(bpe, "CACHED_PAIRS", 2)
    pieces = bpe.Pieces(bpe.read_ranks(PATH))
    text = "the theory of thethe other theses, the theory again and again"
    ids = b"".join(pieces[p] for p in regex.findall(P.PATTERN, text))
    assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)


@given(st.text(max_size=40), st.lists(st.integers(1, 3), max_size=60))
def test_streaming_decode(text, cuts):
    machine, raw, out, at = bpe.Utf8Machine(), text.encode(), "", 0
    for n in cuts:
        out += machine.feed(raw[at : at + n])
        assert len(machine.kept) < 4
        at += n
    assert out + machine.feed(raw[at:], last=True) == text


def test_decoding_damage():
    machine = bpe.Utf8Machine()
    assert machine.feed(b"\xf0\x9f") + machine.feed(b"a") + machine.feed(b"\xc3", last=True) == "�a�"


def test_rows(spark, reference):
    rows = [(1, "Hello wörld", "x"), (2, None, "x"), (3, "", "x"), (3, "", "x"), (None, "a" * 50_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    out = bpe.encode_digests(docs, *bpe.default_vocabulary()).collect()
    assert len(out) == 5
    for (i, t, _), r in zip(rows, out):
        ids = reference.encode_ordinary(t or "")
        assert tuple(r) == (i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    assert bpe.encode_digests(docs.limit(0), *bpe.default_vocabulary()).collect() == []
