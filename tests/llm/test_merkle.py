import hashlib
import zlib

import duckdb
import pytest

from studyloom.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    framed = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return h(*framed)


def tree(leaves):
    """The top of a list of digests, and for each of them its levels of (before, after)."""
    levels, at, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        for i, place in enumerate(at):
            run = nodes[place // 8 * 8 : place // 8 * 8 + 8]
            levels[i].append(("".join(run[: place % 8]), "".join(run[place % 8 + 1 :])))
            at[i] = place // 8
        nodes = [h(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
    return nodes[0], levels


def plain(rows):
    """The query's rows by one tree after the other in Python."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees, out = {}, []
    for lang in langs:
        own = sorted(((r[0] is not None, r[0] or 0, leaf(*r)), r) for r in rows if r[2] == lang)
        trees[lang] = ([r for _, r in own], *tree([leaf(*r) for _, r in own]))
    root, tops = tree([trees[lang][1] for lang in langs])
    for lang, above in zip(langs, tops):
        members, subroot, levels = trees[lang]
        for r, below in zip(members, levels):
            text = r[1]
            if text is not None and zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 3 == 0:
                text = text.translate({c: c + 32 for c in range(65, 91)})
            fold = leaf(r[0], text, *r[2:])
            for before, after in below + above:
                fold = h(before, fold, after)
            proof = h(*[b + a for b, a in below + above])
            out.append((r[0], leaf(*r), subroot, root, proof, fold, fold == root))
    return out


def key(row):
    return tuple((v is not None, v) for v in row)


def got(spark, documents, rows):
    return sorted(map(tuple, merkle.op11_merkle(spark, documents(rows)).collect()), key=key)


@pytest.mark.parametrize("digits", [1, 2, 4])
def test_equals_plain_trees(spark, documents, monkeypatch, digits):
    monkeypatch.setattr(merkle.manifest, "__defaults__", (digits,))
    monkeypatch.setattr(merkle, "RANGE_ROWS", 40)
    sizes = {"a": 1, "b": 8, "c": 9, "d": 64, "é": 65, None: 150, "z": 2, **{f"l{i}": 1 for i in range(4)}}
    rows = [(n * 1000 + i * 7, f"Text {i % 5}", lang, "s", i) for n, lang in enumerate(sizes) for i in range(sizes[lang])]
    assert got(spark, documents, rows) == sorted(plain(rows), key=key)


def test_awkward_rows_and_sql(spark, documents, awkward):
    want = sorted(plain(awkward), key=key)
    assert got(spark, documents, awkward) == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{documents(awkward)}/documents.parquet/*.parquet'")
    assert sorted(con.execute(merkle.SQL).fetchall(), key=key) == want


@pytest.mark.parametrize("rows", [[], [(7, "Lone", "en", "s", 4)]])
def test_empty_and_lone(spark, documents, rows):
    assert got(spark, documents, rows) == (plain(rows) if rows else [])


def test_clashing_columns(spark, documents):
    names = "hash rank n node leaf block kids levels root subroot d0 _at _range".split()
    rows = [(i, "Ab", "en", "s", 2, *names) for i in range(20)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names)
    found = sorted(map(tuple, merkle.op11_merkle(spark, documents(rows, schema)).collect()), key=key)
    assert found == sorted(plain([r[:5] for r in rows]), key=key)


def test_a_changed_field_is_told(spark, documents):
    rows = [(i, "ABC", "en", "s", 3) for i in range(200)]
    found = got(spark, documents, rows)
    assert {r[0] for r in found if not r[6]} == {i for i in range(200) if zlib.crc32(str(i).encode()) % 3 == 0}
