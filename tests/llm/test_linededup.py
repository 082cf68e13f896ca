import hashlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from studyloom.llm import linededup

LOWER = {c: c + 32 for c in range(65, 91)}
LONG = "a passage of at least forty code points, "


def plain(rows):
    """doc_id, lines, dropped lines, digest of every row."""
    name = lambda line: line.strip(linededup.BLANKS).translate(LOWER)
    order = lambda doc: (doc is not None, doc or 0)
    held = defaultdict(set)
    for r in rows:
        for line in (r[1] or "").split("\n"):
            held[name(line)].add(r[0])
    gone = {k: max(docs, key=order) for k, docs in held.items() if len(k) >= 40 and len(docs) >= 5}
    out = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if name(x) not in gone or gone[name(x)] == r[0]]
        out.append((r[0], len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def key(row):
    return tuple((v is not None, v) for v in row)


def got(spark, documents, rows, schema=None):
    folder = documents(rows, schema) if schema else documents(rows)
    return sorted(map(tuple, linededup.op12_linededup(spark, folder).collect()), key=key)


def texts(n):
    """Lines held by 4, 5, 6 and all documents, repeated inside some, with blanks and capitals around."""
    out = []
    for i in range(n):
        lines = [f"own {i}", LONG + "everywhere", LONG + f"by six {i % (n // 6)}", LONG + f"by four {i // 4}", LONG + f"by five {i // 5}"]
        lines += [f"\t {LONG}EVERYWHERE \r"] * (i % 4) + ["short"] + ["" if i % 2 else "x"]
        out.append((i * 13 % n, "\n".join(lines), "en", "s", 0))
    return out


@pytest.mark.parametrize("rows, batch", [(1 << 20, 10000), (50, 7), (3, 1)])
def test_ranges_of_any_size(spark, documents, monkeypatch, rows, batch):
    monkeypatch.setattr(linededup, "RANGE_ROWS", rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        docs = texts(120)
        assert got(spark, documents, docs) == sorted(plain(docs))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_equals_sql(spark, documents):
    docs = texts(60)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{documents(docs)}/documents.parquet/*.parquet'")
    assert sorted(con.execute(linededup.SQL).fetchall()) == sorted(plain(docs))


def test_awkward_rows(spark, documents, awkward):
    line = LONG + "shared"
    more = [(100 + i, f"{line}\nown", None, None, None) for i in range(3)]
    more += [(None, line, "en", "s", 1), (None, f"x\n{line}", "en", "s", 1), (103, f"{line}\n{line}", "en", "s", 1), (103, f"y\n{line}", "en", "s", 1)]
    more += [(104, (line + "\n") * 20000 + "end", "en", "s", 1)] * 2
    rows = awkward + more
    assert got(spark, documents, rows) == sorted(plain(rows), key=key)


def test_four_documents_and_a_null_one_are_five(spark, documents):
    line = LONG + "shared"
    rows = [(i, line, "en", "s", 1) for i in (None, 1, 2, 3, 4)]
    assert [r[2] for r in got(spark, documents, rows)] == [1, 1, 1, 1, 0]
    assert all(r[2] == 0 for r in got(spark, documents, rows[1:]))


def test_empty_table(spark, documents):
    assert got(spark, documents, []) == []


def test_clashing_columns(spark, documents):
    names = "doc keep kept h1 h2 pos edge text_hash n_lines n_dropped gone _id _hash".split()
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names)
    docs = texts(30)
    assert got(spark, documents, [(*r, *names) for r in docs], schema) == sorted(plain(docs))
    rows = spark.createDataFrame([(*r, *names) for r in docs], schema)
    assert linededup.deduplicated(rows).select("doc.*").columns == rows.columns


def test_bitmaps():
    for gone in ([0], [7], [8], [3, 4, 500], list(range(90))):
        keep = linededup.unpacked(linededup.packed(gone), 600)
        assert list(np.flatnonzero(~keep)) == gone
    assert len(linededup.packed(list(range(10000)))) < 60
