from collections import Counter

import duckdb
import pytest

from studyloom.llm import mixing


def run(spark, documents, rows):
    return mixing.op1_mixing(spark, documents(rows)).collect()


def test_matches_sql(spark, documents):
    rows = [(i, "w " * (i * 37 % 50), "en", ["big", "big", "big", "s1", "s2", None, "s3"][i % 7], 0) for i in range(400)]
    folder = documents(rows)
    got = mixing.op1_mixing(spark, folder).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    want = con.execute(mixing.SQL).fetchall()
    key = lambda r: (r[0], r[1], r[2], round(r[3], 6), r[4])
    assert sorted(map(key, got)) == sorted(map(key, want))


def test_targets_and_limits(spark, documents):
    rows = [(i, "w " * 10, "en", "abc"[i % 3], 0) for i in range(300)]
    got = run(spark, documents, rows)
    taken = Counter()
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        taken[r.doc_id % 3] += r.taken
    assert sum(taken.values()) == 3 * 3000 // 2
    for k, share in enumerate((3, 1, 2)):
        target = min(2000, 4500 * share / 6) if k == 0 else None
        if target:
            assert abs(taken[k] - 2000) <= 10
    assert abs(taken[1] / taken[2] - 0.5) < 0.02


def test_many_ranges_equal_one(spark, documents, monkeypatch):
    rows = [(i, "w " * (i % 23), "en", "ab"[i % 2], 0) for i in range(500)]
    want = sorted(run(spark, documents, rows))
    monkeypatch.setattr(mixing, "RANGE_ROWS", 30)
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 7)
    monkeypatch.setattr(mixing, "MAX_BUCKETS", 9)
    assert sorted(run(spark, documents, rows)) == want


def test_awkward_rows(spark, documents, awkward):
    got = run(spark, documents, awkward)
    assert len(got) == len(awkward)
    assert all(r.taken == 0 for r in got if r.size == 0)
    assert sum(r.taken for r in got) == sum(r.size for r in got) * 3 // 2


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)]])
def test_nothing_to_mix(spark, documents, rows):
    assert [(r.size, r.taken) for r in run(spark, documents, rows)] == [(0, 0)] * len(rows)


def test_copies_as_rows(spark, documents, awkward):
    docs = spark.createDataFrame(awkward, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "doc_id AS size", "doc_id AS copies", "doc_id AS cum", "doc_id AS _key", "doc_id AS _size", "doc_id AS key", "doc_id AS doc", "doc_id AS at", "doc_id AS rows1")
    got = mixing.mixed(docs)
    assert got.columns == docs.columns
    rows = got.collect()
    assert all(set(r[5:]) == {r.doc_id} for r in rows)
    assert {r[:5] for r in rows} <= set(awkward)
    n = Counter(r.doc_id for r in rows)
    assert n and max(n.values()) <= 6 and 1 not in n
