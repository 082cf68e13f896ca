import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from studyloom.llm import search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words(text):
    return TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def plain(docs, items, top=50):
    """Every document scored for every item."""
    held = [(r[0], Counter(words(r[1]))) for r in docs]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    n, length = len(held), sum(x[2] for x in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item_id, text in items:
        rows = []
        for d, c, size in held:
            m = 50 + 50 * size * n // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in set(words(text)) if c[t])
            if s > 0:
                rows.append((-s, d is None, d or 0))
        out += [(item_id, i + 1, None if null else d, -s) for i, (s, null, d) in enumerate(sorted(rows)[:top])]
    return out


def key(row):
    return tuple((v is not None, v) for v in row)


def collection(n):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(60)] + ["Été", "漢字", "x1"]
    draw = lambda k: " ".join(rng.choice(vocabulary, k, p=(p := 1 / np.arange(1, 64)) / p.sum()))
    docs = [(int(i * 7 % n), draw(rng.integers(1, 60)), "en", "s", 0) for i in range(n)]
    return docs, [(i, draw(8)) for i in range(12)]


def got(spark, documents, docs, items, schema=None):
    folder = documents(docs, schema) if schema else documents(docs)
    documents(items, "item_id long, text string", "benchmark")
    return sorted(map(tuple, search.op13_search(spark, folder).collect()), key=key)


@pytest.mark.parametrize("cells, block, wave", [(1 << 24, 64, 1 << 16), (1500, 4, 30), (60, 1, 1)])
def test_equals_scoring_everything(spark, documents, monkeypatch, cells, block, wave):
    monkeypatch.setattr(search, "SHARD_CELLS", cells)
    monkeypatch.setattr(search, "BLOCK_DOCS", block)
    monkeypatch.setattr(search, "WAVE_TERMS", wave)
    docs, items = collection(400)
    assert got(spark, documents, docs, items) == sorted(plain(docs, items), key=key)


def test_equals_sql(spark, documents):
    docs, items = collection(200)
    folder = documents(docs)
    documents(items, "item_id long, text string", "benchmark")
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    assert sorted(con.execute(search.SQL).fetchall()) == sorted(plain(docs, items))


def test_awkward_rows(spark, documents, awkward):
    items = [(1, "the cat sat"), (1, "the cat sat"), (None, "漢字 it"), (2, None), (3, ""), (4, "!!"), (5, "the " * 30000 + "nowhere")]
    copies = [(1000 + i, "the cat sat on a mat", "en", "s", 1) for i in range(70)] + [(1000, "the cat sat on a mat", "en", "s", 1)] * 3
    docs = awkward + copies
    assert got(spark, documents, docs, items) == sorted(plain(docs, items), key=key)


@pytest.mark.parametrize("docs, items", [([], [(1, "a")]), ([(1, "a", "en", "s", 1)], []), ([], [])])
def test_empty_tables(spark, documents, docs, items):
    assert got(spark, documents, docs, items) == []


def test_clashing_columns(spark, documents):
    names = "item item_id rank score terms counts n part term count".split()
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names)
    docs, items = collection(60)
    assert got(spark, documents, [(*r, *names) for r in docs], items, schema) == sorted(plain(docs, items), key=key)


def test_blocks_are_skipped(monkeypatch):
    """Two kinds of documents: the lists fall apart by kind, and the blocks of the other kind are never scored."""
    rng = np.random.default_rng(1)
    n, terms = 2000, 40
    rows = np.repeat(np.arange(n), 10)
    kind = (np.arange(n) % 2)[:, None] * 19
    at = np.concatenate((np.full((n, 1), 39), kind + np.array([rng.choice(19, 9, replace=False) for _ in range(n)])), axis=1)
    stats = search.Statistics(n, 10 * n, np.full(terms, 1000))
    shard = search.Shard(np.arange(n), np.full(n, 10), rows, at.ravel(), np.ones(10 * n, np.int64), stats)
    asked = np.array([0, 1, 2, 3, 39])
    coordinates = search.partners([asked], terms)
    best, scored = search.Best(10), []
    add = search.Best.add
    monkeypatch.setattr(search.Best, "add", lambda self, score, doc, null: (scored.append(len(doc)), add(self, score, doc, null)))
    search.walk(shard, np.zeros(n, bool), asked, stats.weights, coordinates, best)
    everything = shard.parts[:, asked].astype(np.int64) @ stats.weights[asked]
    assert list(best.score) == sorted(everything, reverse=True)[:10]
    assert sum(scored) < n
