import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from studyloom.llm import simhash as S


def check(spark, folder, rows):
    got = S.op3_fingerprints(spark, folder).collect()
    assert len(got) == len(rows)
    order = sorted(((r[0] is None, r[0] or 0, (r[1] or "").encode(), r[1] or "") for r in rows), key=lambda x: x[:3])
    want = []
    for i, (none, doc_id, _, text) in enumerate(order):
        follow = order[(i + 1) % len(order)][3]
        half = len(text) // 2
        edited = text[: len(text) - half] + follow[:half]
        want.append((none, doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_chars, r.edited_sha256) for r in got) == sorted(want)
    return got


def likeness(a, b):
    return 1 - (int(a, 16) ^ int(b, 16)).bit_count() / S.BITS


def test_awkward_rows(spark, documents, awkward):
    got = check(spark, documents(awkward), awkward)
    by_id = {r.doc_id: r for r in got}
    assert by_id[0].fingerprint == by_id[1].fingerprint == by_id[2].fingerprint == "0" * 32
    assert by_id[5].fingerprint == by_id[6].fingerprint == by_id[7].fingerprint != by_id[3].fingerprint
    for r in got:
        assert r.near_edited == likeness(r.fingerprint, r.edited_fingerprint)


def test_many_bins(spark, documents, monkeypatch):
    monkeypatch.setattr(S, "BIN_ROWS", 4)
    monkeypatch.setattr(S, "FAN", 3)
    rows = [(i * i * 1000 - 5, f"word{i} common text here number {i % 7} and more of it " * (i % 5 + 1), "en", "a", 0) for i in range(101)]
    got = {r.doc_id: r for r in check(spark, documents(rows), rows)}
    ids = sorted(got)
    for a, b in zip(ids, ids[1:] + ids[:1], strict=True):
        assert got[a].near_next == likeness(got[a].fingerprint, got[b].fingerprint)
    for a in ids:
        near = sum((int(got[a].fingerprint, 16) ^ int(r.fingerprint, 16)).bit_count() <= 3 for r in got.values())
        assert got[a].n_near == (near if a % 50 == 0 else None)


def test_counts_beyond_a_chunk(spark, monkeypatch):
    text = " ".join(f"w{i % 700} longerword{i % 13}" for i in range(3000))
    d = spark.createDataFrame([(1, text)], "k long, text string")
    want = S.fingerprints(d, ["k"]).first()
    monkeypatch.setattr(S, "CHUNK", 100)
    assert S.fingerprints(d, ["k"]).first() == want


def test_counts_beyond_a_counter(spark, documents):
    """More than 32,767 votes for a bit, from one word, one line, and words of a power law."""
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    law = " ".join(f"frequent{int(1 / (((i * 7919) % 60000 + 1) / 60000)) % 500}" for i in range(60000))
    texts = ["spam " * 40000, "one line of five longerwords " * 8000, law]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in check(spark, documents(rows), rows)}
    for i, t in enumerate(texts):
        votes, weights = [0] * S.BITS, 0
        words = t.split()
        pairs = spark.createDataFrame([(a, b) for a, b in set(zip(words, words[1:]))], "a string, b string")
        hashes = {(r.a, r.b): (r.h0, r.h1) for r in pairs.select("a", "b", F.xxhash64("a", "b").alias("h0"), F.xxhash64("b", F.lit(1), "a").alias("h1")).collect()}
        for (a, b), n in Counter(zip(words, words[1:])).items():
            w = n * (2 if len(a) + len(b) >= S.LONG_PAIR else 1)
            weights += w
            bits = (hashes[a, b][0] & (1 << 64) - 1) << 64 | hashes[a, b][1] & (1 << 64) - 1
            for k in range(S.BITS):
                votes[k] += w * (bits >> k & 1)
        assert int(got[i].fingerprint, 16) == sum(1 << k for k in range(S.BITS) if votes[k] * 2 > weights)


@pytest.mark.parametrize("radius", [1, 2, 3, 5])
def test_blocks_cover_all_bits(spark, radius):
    d = spark.sql("SELECT -1L AS hi, -1L AS lo")
    values = d.select(*S.block_values(d.hi, d.lo, radius)).first()
    assert len(values) == radius + 1
    assert sum((v if v >= 0 else v + (1 << 64)).bit_count() for v in values) == S.BITS


def test_empty_and_single(spark, documents):
    check(spark, documents([]), [])
    row = [(50, "only one of these", "en", "a", 0)]
    assert check(spark, documents(row), row)[0].near_next == 1.0


def test_no_python_in_plan(spark, documents, awkward):
    plan = S.op3_fingerprints(spark, documents(awkward))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
