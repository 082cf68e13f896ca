import hashlib
import random

import numpy as np
import pytest

from studyloom.llm import bpe


@pytest.fixture(scope="module")
def library():
    return bpe.coder(*bpe.production()).core


@pytest.mark.parametrize("leaf", [5, 64, 8192])
def test_equals_library(library, leaf):
    coder = bpe.Coder(*bpe.production(), leaf=leaf)
    rnd = random.Random(leaf)
    for alphabet in ("ab'st  \n\t", "a1 .,'re 　é漢😀\x1c\x85", "aaaa b"):
        for _ in range(300):
            text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 300)))
            ids = coder.encode(text)
            assert ids.tolist() == library.encode_ordinary(text)
            assert coder.decode(ids) == text.encode()


def test_long_runs(library):
    coder = bpe.coder(*bpe.production())
    for text in ("a" * 50_000, "ab" * 30_000, "\n" * 30_000 + "x", "é" * 20_001):
        assert coder.encode(text).tolist() == library.encode_ordinary(text)
    blanks = " " * 300_000
    assert coder.decode(coder.encode(blanks + "word")) == (blanks + "word").encode()


def test_query(spark, documents, awkward, library):
    got = bpe.op8_bpe(spark, documents(awkward)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    want = []
    for doc_id, text, *_ in awkward:
        ids = library.encode_ordinary(text or "")
        want.append((doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_most_texts_are_joined_from_halves(spark, library, monkeypatch):
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    coder = bpe.Coder(*bpe.production())
    joined, decoded = set(), set()
    plain_join, plain_decode = bpe.Coder._join, bpe.Coder.decode
    monkeypatch.setattr(bpe.Coder, "_join", lambda self, text, *a: joined.add(text) or plain_join(self, text, *a))
    monkeypatch.setattr(bpe.Coder, "decode", lambda self, ids: decoded.add(len(ids)) or plain_decode(self, ids))
    for t in texts:
        ids = coder.encode(t)
        assert ids.tolist() == library.encode_ordinary(t) and coder.decode(ids) == t.encode()
    assert len(joined) * 2 > len(set(texts)) and any(0 < n <= bpe.DECODE_LEAF for n in decoded)


def test_clashing_columns(spark, documents):
    schema = "doc_id long, text string, ids string, decoded int, n_tokens string"
    got = bpe.op8_bpe(spark, documents([(1, "some text", "x", 2, "y")], schema)).collect()
    assert [(r.doc_id, r.n_tokens) for r in got] == [(1, 2)]


def test_empty_table(spark, documents):
    assert bpe.op8_bpe(spark, documents([])).collect() == []
    assert bpe.coder(*bpe.production()).decode(np.array([], dtype=np.int64)) == b""
