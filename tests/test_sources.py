import io
import struct
import zipfile

from pyspark.sql import functions as F

from studyloom.operators import headers as H
from studyloom.sources import containers, imaging_header, listing, sinks


def element(tag, vr, value, explicit=True):
    raw = value if isinstance(value, bytes) else value.encode()
    raw += (b"\0" if vr == "UI" else b" ") * (len(raw) % 2)
    head = struct.pack("<HH", tag >> 16, tag & 0xFFFF)
    if not explicit:
        return head + struct.pack("<I", len(raw)) + raw
    if vr.encode() in imaging_header.LONG_VRS:
        return head + vr.encode() + b"\0\0" + struct.pack("<I", len(raw)) + raw
    return head + vr.encode() + struct.pack("<H", len(raw)) + raw


def item(body):
    return struct.pack("<HHI", 0xFFFE, 0xE000, len(body)) + body


def sequence(tag, items, undefined=False):
    body = b"".join(map(item, items))
    head = struct.pack("<HH", tag >> 16, tag & 0xFFFF) + b"SQ\0\0"
    if undefined:
        return head + struct.pack("<I", 0xFFFFFFFF) + body + struct.pack("<HHI", 0xFFFE, 0xE0DD, 0)
    return head + struct.pack("<I", len(body)) + body


def dataset(explicit=True, n=1, nested=True):
    t = imaging_header.TAGS
    vrs = [("SOPClassUID", "UI", "1.2.840"), ("SOPInstanceUID", "UI", f"1.2.3.{n}"), ("StudyDate", "DA", "20240102"), ("Modality", "CS", "XA")]
    out = b"".join(element(t[k], vr, v, explicit) for k, vr, v in vrs)
    if nested and explicit:
        out += sequence(0x00081140, [element(t["PatientName"], "PN", "INNER")], undefined=n % 2 == 0)
    more = [("PatientName", "PN", "CHEN^SU M-56Y"), ("PatientID", "LO", "P1"), ("StudyInstanceUID", "UI", "1.2.3"), ("SeriesInstanceUID", "UI", "1.2.3.4")]
    out += b"".join(element(t[k], vr, v, explicit) for k, vr, v in more)
    return out + element(0x7FE00010, "OW", b"\xff" * 50, explicit)


def file(explicit=True, n=1):
    syntax = imaging_header.EXPLICIT_LE if explicit else imaging_header.IMPLICIT_LE
    meta = element(0x00020010, "UI", syntax)
    return b"\0" * 128 + b"DICM" + element(0x00020000, "UL", struct.pack("<I", len(meta))) + meta + dataset(explicit, n)


def test_header_scan(spark, tmp_path):
    root = tmp_path / "in"
    (root / "a" / ".hidden").mkdir(parents=True)
    for name, data in {
        "a/1.dcm": file(), "a/2": file(n=2), "a/3": file(explicit=False, n=3), "a/4": dataset(explicit=False, n=4), "a/bad": b"hello world, this is no header at all", "a/empty": b"",
        "a/note.txt": b"x", "a/DICOMDIR": file(), "a/.hidden/5": file(), "out/6": file(),
    }.items():
        (root / name).parent.mkdir(exist_ok=True)
        (root / name).write_bytes(data)
    scanned = imaging_header.read_headers(spark, str(root), exclude=str(root / "out"))
    hdr, rejected = imaging_header.headers(scanned)
    rows = {r.relative_path.rsplit("/", 1)[1]: r for r in hdr.collect()}
    assert sorted(rows) == ["1.dcm", "2", "3", "4"] and sorted(r.path.rsplit("/", 1)[1] for r in rejected.collect()) == ["bad"]
    assert all((r.patient_name_raw, r.patient_id_raw, r.study_uid, r.modality_raw, r.study_date_raw) == ("CHEN^SU M-56Y", "P1", "1.2.3", "XA", "20240102") for r in rows.values())
    hdr = hdr.withColumn("source_subject", F.lit("s"))
    s = H.study_summary(H.series_summary(H.normalised(hdr.withColumn("payload", F.lit(""))))).first()
    assert (s.study_uid, s.file_count, s.display_type) == ("1.2.3", 4, "XA")


def test_nested_elements():
    _, found = imaging_header.parse(file(n=2))
    assert ("root/00081140[0]", imaging_header.TAGS["PatientName"], b"PN", b"INNER ") in found
    assert not any(tag >= imaging_header.PIXELS for _, tag, _, _ in found)


def test_listing(spark, tmp_path):
    (tmp_path / "15_H001 x" / "sub").mkdir(parents=True)
    (tmp_path / "15_H001 x" / "sub" / "f.dcm").write_bytes(b"1234")
    (tmp_path / "b.zip").write_bytes(b"zip")
    d = listing.listing(spark, str(tmp_path))
    r = listing.sources(d).select("size", listing.relative(F.col("path"), str(tmp_path)).alias("p")).collect()
    assert [(x.size, x.p) for x in r] == [(4, "15_H001%20x/sub/f.dcm")] or [(x.size, x.p) for x in r] == [(4, "15_H001 x/sub/f.dcm")]
    assert listing.archives(d).count() == 1
    g = spark.createDataFrame([("15_H001 x/f",), ("other/f",)], "p string").select(listing.packages(F.col("p")).alias("g")).collect()
    assert [x.g.group for x in g] == ["15-H001", ""]
    (tmp_path / "list.txt").write_bytes("﻿/a/b  \r\n\r\n/c\n".encode())
    assert [x.path for x in listing.path_list(spark, str(tmp_path / "list.txt")).collect()] == ["/a/b", "/c"]


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        for name in ("ok/f", "../up", "/abs", "C:/win"):
            z.writestr(name, b"data")
    (tmp_path / "b.zip").write_bytes(b"no archive")
    got = {(r.archive.rsplit("/", 1)[1], r.member): (r.problem, r.content) for r in containers.zip_members(spark, str(tmp_path)).collect()}
    assert got[("a.zip", "ok/f")] == ("", b"data") and got[("b.zip", "")][0] == "not_an_archive"
    assert {p for (a, _), (p, c) in got.items() if c is None} == {"parent", "absolute", "not_an_archive"}
    assert {r.problem for r in containers.zip_members(spark, str(tmp_path), max_bytes=3).collect()} == {"too_large", "not_an_archive"}


def test_workbooks(spark, tmp_path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    sheet = f"""<worksheet {ns}><sheetData><row r="1"><c r="A1" t="inlineStr"><is><t>title</t></is></c></row>
<row r="2"><c r="A2" t="s"><v>0</v></c><c r="C2" t="s"><v>1</v></c></row><row r="3"><c r="A3"><v>7</v></c><c r="C3" t="inlineStr"><is><t>x</t></is></c></row><row r="4"><c r="A4"><v>8</v></c></row></sheetData></worksheet>"""
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} {rel}><sheets><sheet name="S" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/s1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>住院号</t></si><si><r><t>患</t></r><r><t>者</t></r></si></sst>")
        z.writestr("xl/worksheets/s1.xml", sheet)
    (tmp_path / "t.xlsx").write_bytes(data.getvalue())
    rows = containers.workbook_rows(spark, str(tmp_path))
    assert [(r.row, r.cells) for r in rows.orderBy("row").collect()] == [(1, ["title"]), (2, ["住院号", "", "患者"]), (3, ["7", "", "x"]), (4, ["8"])]
    t = containers.as_table(rows, ["id", "患者"], aliases={"住院号": "id"})
    assert [(r["__row__"], r["id"], r["患者"]) for r in t.orderBy("__row__").collect()] == [(3, "7", "x"), (4, "8", "")]


def test_sinks(spark, tmp_path):
    d = spark.createDataFrame([(1, "=1+1"), (2, "ok")], "a int, b string")
    sinks.write_csv(d, str(tmp_path / "csv"))
    assert sorted(r.b for r in spark.read.option("header", True).csv(str(tmp_path / "csv")).collect()) == ["'=1+1", "ok"]
    for v in ("000", "001"):
        sinks.publish(d.where(F.col("a") <= int(v) + 1), str(tmp_path / "state"), v)
    assert sinks.current(spark, str(tmp_path / "state")).count() == 2


def test_sheet_names_are_unique_whatever_their_case(spark):
    names = ["a", "A", "a_2", "x/y", "x:y", "n" * 40, "N" * 35 + "?", "'", None, " '' "]
    got = {r.name: r.sheet for r in sinks.sheet_names(spark.createDataFrame([(n,) for n in names], "name string")).collect()}
    assert len(got) == len(names) and len({s.casefold() for s in got.values()}) == len(got) and all(0 < len(s) <= 31 for s in got.values())
    assert got["A"] == "A" and got["a"] == "a_2" and got["a_2"] == "a_2_2"  # in the order of names
    assert got["x/y"] == "x_y" and got["x:y"] == "x_y_2" and got["N" * 35 + "?"] == "N" * 31 and got["n" * 40] == "n" * 29 + "_2"
    assert {got[""], got["'"], got[" '' "]} == {"中心", "中心_2", "中心_3"}


def test_report_tables_are_read_back(spark, tmp_path):
    rows = spark.createDataFrame([("x", 1), ("y", 2), ("x", 3)], "center string, n int")
    sinks.write_tables({"rows": rows, "faults": rows.where("false")}, str(tmp_path / "r"), {"rows": "center"})
    back = sinks.read_tables(spark, str(tmp_path / "r"), ["rows", "faults"])
    assert sorted((r.center, r.n) for r in back["rows"].collect()) == [("x", 1), ("x", 3), ("y", 2)] and back["faults"].count() == 0
    assert {p.name for p in (tmp_path / "r" / "rows").iterdir() if p.is_dir()} == {"center=x", "center=y"}


def test_repeated_blocks(spark):
    head = ["#", "中心名称", "姓名", "", "#", "姓名", "中心名称", "备注"]
    rows = [
        ("same", 1, ["title"]), ("same", 2, head), ("same", 3, ["7", "A", "li", "", "7", "li", "A", "n"]), ("same", 4, ["", "", "wu", "", "x", "wu"]), ("same", 5, []),
        ("other", 1, head), ("other", 2, ["1", "A", "li", "", "1", "li", "B"]),
        ("less", 1, head), ("less", 2, ["1", "A", "li"]), ("one", 1, ["姓名", "中心名称"]), ("one", 2, ["li", "A"]), ("none", 1, ["姓名"]),
    ]
    d = spark.createDataFrame([("w", *r) for r in rows], "workbook string, sheet string, row int, cells array<string>")
    long = containers.repeated_blocks(d, ["中心名称", "姓名"], ["备注"])
    got = {(r.sheet, r.block, r["__row__"]): (r["__order__"], r.中心名称, r.姓名, r.备注) for r in long.collect()}
    assert got["same", 1, 3] == (7, "A", "li", "n") and got["same", 2, 3] == (7, "A", "li", "") and got["same", 2, 4] == (2, "", "wu", "")
    assert ("same", 1, 5) not in got and got["one", 1, 2] == (1, "A", "li", "") and not any(s == "none" for s, *_ in got)
    bad = containers.differing_blocks(long, ["中心名称", "姓名"])
    assert sorted((r.sheet, r.block) for r in bad.collect()) == [("other", 2)]
    # a block without rows differs from one with rows only if it is told of at all
    more = long.union(d.sparkSession.createDataFrame([("w", "same", 2, 9, 1, "", "zhao", "")], long.schema))
    assert sorted((r.sheet, r.block) for r in containers.differing_blocks(more, ["中心名称", "姓名"]).collect()) == [("other", 2), ("same", 2)]


def test_transferred_files_counts_and_headerless_places(spark, tmp_path):
    for name in ("outputs/in/1.dcm", "outputs/in/logs/2.dcm", "outputs/in/a/_quarantine/3.dcm", "outputs/in/.x/4.dcm", "outputs/in/5.png", "outputs/in/a/6", "outputs/in/a/7.LOG", "outputs/in/a/8"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"not a header, only text" if name.endswith("8") else file())
    root = str(tmp_path / "outputs" / "in")
    kept = listing.transferred(listing.listing(spark, root), root)
    assert sorted(r.path.rsplit("/", 1)[1] for r in kept.collect()) == ["1.dcm", "6", "8"]
    scanned = imaging_header.read_headers(spark, root).join(kept.select("path"), "path")
    assert tuple(imaging_header.scan_counts(scanned).first()) == (3, 2, 0, 1)
    by = scanned.withColumn("folder", F.element_at(F.split("path", "/"), -2))
    assert {r.folder: (r.files, r.images) for r in imaging_header.scan_counts(by, "folder").collect()} == {"in": (1, 1), "a": (2, 1)}
    rows = [("/s/1.2/1.3/1.4.dcm", "1.2", "1.3", "1.4"), ("/s/1.2/1.3/1.4.DCM", "1.2", "1.3", "1.4"), ("/s/1.2/1.9/1.5.bin", "1.8", "1.3", "1.4"), ("/s/1.2/1.4.dcm", "1.2", "1.3", "1.4"), ("/t/1.4.dcm", "1.2", "1.3", "1.4")]
    d = spark.createDataFrame(rows, "path string, study string, series string, sop string")
    why = d.select(imaging_header.headerless_problems(d.path, F.lit("/s/1.2"), d.study, d.series, d.sop).alias("w")).collect()
    assert [r.w for r in why] == [[], [], ["study_folder", "series_folder", "file_name"], ["level"], ["outside_study"]]
