"""Publishing of bytes, and logs whose last line is torn."""

import hashlib
import json
import os

import pytest

from studyloom.operators import files as P
from studyloom.sources import logs, publish


@pytest.fixture
def world(spark, tmp_path):
    source, root = tmp_path / "in", tmp_path / "out"
    source.mkdir(), root.mkdir()
    rows = []
    for i in range(40):
        data = b"bytes %d" % (i % 20 if i < 30 else i) * (1 + i % 2 * 200000)
        (source / f"{i:02d}").write_bytes(data)
        target = "_quarantine/%02d.dcm" % i if i % 13 == 5 else f"P{i % 5}/1.2.{i % 4}.dcm"
        rows.append((f"file:{source}/{i:02d}", f"{i:02d}", target))
    return spark.createDataFrame(rows, "path string, relative_path string, target string"), str(root), source


def tree(root):
    return {os.path.relpath(os.path.join(d, n), root): open(os.path.join(d, n), "rb").read() for d, _, names in os.walk(root) for n in names}


def test_bytes_are_published_once(spark, world):
    files, root, source = world
    planned = publish.plan(files, root)
    want = {r.relative_path: (r.status, r.final_target) for r in P.copy_status(publish.with_digests(files)).collect()}
    assert {r.relative_path: (r.status, r.final_target) for r in planned.collect()} == want
    assert {s for s, _ in want.values()} == {"copied", "conflict", "duplicate_same", "quarantined"}
    assert {r.outcome for r in publish.publish(planned, root, execute=False).collect()} == {"planned", "duplicate_same"} and tree(root) == {}
    done = publish.publish(planned, root)
    assert {r.outcome for r in done.collect()} == {"written", "duplicate_same"} and done.collect() == done.collect()
    there = tree(root)
    assert there == {t: (source / r).read_bytes() for r, (s, t) in want.items() if s != "duplicate_same"}
    again = publish.publish(publish.plan(files, root), root).collect()
    assert {r.outcome for r in again} <= {"duplicate_same", "present"} and tree(root) == there


def test_a_task_that_is_repeated_leaves_one_file(world, monkeypatch):
    files, root, source = world
    planned = [r for r in publish.plan(files, root).collect() if r.status != "duplicate_same"]
    for r in planned[:5]:
        assert publish.put(r.path, root, r.final_target, r.sha) == "written"
    killed = planned[5]

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(publish.os, "link", dies)
        with pytest.raises(KeyboardInterrupt):
            publish.put(killed.path, root, killed.final_target, killed.sha)
    (source.parent / "out" / publish.STAGING / "left").write_bytes(b"half")
    outcomes = [publish.put(r.path, root, r.final_target, r.sha) for r in planned]
    assert outcomes == ["present"] * 5 + ["written"] * (len(planned) - 5)
    found = tree(root)
    assert found.pop(f"{publish.STAGING}/left") and {t: hashlib.sha256(b).hexdigest() for t, b in found.items()} == {r.final_target: r.sha for r in planned}


def test_what_stands_there_is_never_replaced(spark, world):
    files, root, source = world
    os.makedirs(f"{root}/P0")
    open(f"{root}/P0/1.2.0.dcm", "wb").write(b"other")
    done = publish.publish(publish.plan(files, root), root).collect()
    assert tree(root)["P0/1.2.0.dcm"] == b"other"
    beside = [r for r in done if r.target == "P0/1.2.0.dcm" and r.outcome == "written"]
    assert beside and all(r.status == "conflict" and r.final_target == f"P0/1.2.0.{r.sha[:12]}.conflict.dcm" for r in beside)
    r = next(r for r in done if r.outcome == "written")
    assert publish.put(r.path, root, "new.dcm", "0" * 64) == "source_changed" and publish.put("file:/none", root, "x.dcm", "0" * 64) == "source_changed"
    assert publish.put(r.path, root, "P0/1.2.0.dcm", r.sha) == "conflict" and "new.dcm" not in tree(root)


SCHEMA = "path string, size long, note string"


def test_a_log_cut_at_every_byte_of_its_last_row(spark, tmp_path):
    rows = [{"path": f"p{i % 3}", "size": i, "note": "naïve, 漢\"字" if i % 2 else ""} for i in range(6)]
    data = "".join(json.dumps(r, ensure_ascii=False) + "\n" for r in rows).encode()
    last = data[:-1].rfind(b"\n") + 1
    for cut in range(last, len(data) + 1):
        (tmp_path / f"{cut:04d}.jsonl").write_bytes(data[:cut])
    got, faults = logs.json_log(spark, str(tmp_path), SCHEMA)
    assert faults.count() == 0
    held = {}
    for r in sorted(got.collect(), key=lambda r: r.position):
        held.setdefault(int(r.position.file[-10:-6]), []).append({"path": r.path, "size": r.size, "note": r.note})
    for cut in range(last, len(data) + 1):
        assert held[cut] == (rows if cut >= len(data) - 1 else rows[:-1])


def test_csv_logs_drop_their_torn_row(spark, tmp_path):
    head, body = "﻿path,size,note\r\n", ['p0,0,"a, ""b"""\r\n', "p1,1,\r\n", "p0,2,x\r\n"]
    data = (head + "".join(body)).encode()
    last = len(data) - len(body[-1])
    for cut in range(last, len(data) + 1):
        (tmp_path / f"{cut:04d}.csv").write_bytes(data[:cut])
    got, faults = logs.csv_log(spark, str(tmp_path), ["path", "size", "note"])
    assert faults.count() == 0
    held = {}
    for r in sorted(got.collect(), key=lambda r: r.position):
        held.setdefault(int(r.position.file[-8:-4]), []).append((r.path, r.size, r.note))
    want = [("p0", "0", 'a, "b"'), ("p1", "1", ""), ("p0", "2", "x")]
    for cut in range(last, len(data) + 1):
        assert held[cut] == (want if cut == len(data) else want[:2])


def test_faults_and_last_rows(spark, tmp_path):
    a, b = tmp_path / "a.jsonl", tmp_path / "b.jsonl"
    a.write_text('{"path": "p", "size": 1, "note": "old"}\nbroken\n\n{"path": "q", "size": 2, "note": "only"}\n')
    b.write_text('{"path": "p", "size": 3, "note": "mid"}\n{"path": "p", "size": 4, "note": "new"}\n{"path": "p", "si')
    os.utime(a, (1, 1))
    got, faults = logs.json_log(spark, str(tmp_path), SCHEMA)
    assert [r.text for r in faults.collect()] == ["broken"]
    assert {r.path: (r.size, r.note) for r in logs.last_rows(got, ["path"]).collect()} == {"p": (4, "new"), "q": (2, "only")}
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "good.csv").write_text("path,size\np,1\np\np,1,2\n")
    (tmp_path / "csv" / "bad.csv").write_text("size,path\n1,p\n")
    got, faults = logs.csv_log(spark, str(tmp_path / "csv"), ["path", "size"])
    assert [(r.path, r.size) for r in got.collect()] == [("p", "1")] and sorted(r.text for r in faults.collect()) == ["1,p", "p", "p,1,2", "size,path"]


def test_splits_of_a_log(spark, tmp_path):
    rows = [{"path": f"p{i % 50}", "size": i, "note": "n" * (i % 90)} for i in range(3000)]
    (tmp_path / "x.jsonl").write_text("".join(json.dumps(r) + "\n" for r in rows)[:-5])
    spark.conf.set("spark.sql.files.maxPartitionBytes", 10_000)
    try:
        got, faults = logs.json_log(spark, str(tmp_path), SCHEMA)
        assert faults.count() == 0 and got.count() == 2999
        assert {r.path: r.size for r in logs.last_rows(got, ["path"]).collect()} == {r["path"]: r["size"] for r in rows[:-1]}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
