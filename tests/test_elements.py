"""Whole nested headers from files, and de-identification of what was read."""

import hashlib
import os
import struct

import pytest
from pyspark.sql import functions as F
from test_sources import element, file, sequence

from studyloom.operators import deident
from studyloom.sources import imaging_header as I

NAME, INSTITUTION, DESCRIPTION = 0x00100010, 0x00080080, 0x0008103E


def nested_file(pixels=b"\x01\x02" * 40, undefined=True):
    """Items in items, some of undefined length, private tags, a sequence in a private one, pixels and padding behind them."""
    deep = element(NAME, "PN", "DEEP^NAME") + element(0x0020000D, "UI", "1.2.9") + element(0x00080020, "DA", "20240131")
    inner = sequence(0x00081115, [deep + element(DESCRIPTION, "LO", "seen at Clinic A")], undefined)
    outer = sequence(0x00081140, [element(0x00081155, "UI", "1.2.3.1") + inner, element(0x00081030, "LO", "second item")], not undefined)
    private = sequence(0x70051010, [element(NAME, "PN", "PRIVATE^NAME")], undefined)
    body = [
        element(0x00080018, "UI", "1.2.3.1"), element(0x00080020, "DA", "20240102"), element(0x00080030, "TM", "101530.25"), element(INSTITUTION, "LO", "Clinic A"), outer,
        element(NAME, "PN", "CHEN^SU"), element(0x00100020, "LO", "P1"), element(0x00100030, "DA", "19500101"), element(0x00101002, "SQ", b""),
        element(0x0020000D, "UI", "1.2.3"), element(0x0020000E, "UI", "1.2.4\\1.2.5"), element(0x00091010, "OB", b"x" * 6000), private, element(0x7FE00010, "OW", pixels),
        element(0xFFFCFFFC, "OB", b"\0" * 10),
    ]
    meta = element(0x00020003, "UI", "1.2.3.1") + element(0x00020010, "UI", I.EXPLICIT_LE)
    return b"\0" * 128 + b"DICM" + element(0x00020000, "UL", struct.pack("<I", len(meta))) + meta + b"".join(body)


def texts(rows):
    return {(e.path, e.tag): e.value for e in rows}


@pytest.fixture
def read(spark, tmp_path):
    def go(files, **how):
        for name, data in files.items():
            (tmp_path / name).write_bytes(data)
        return I.read_elements(spark, str(tmp_path), **how)

    return go


@pytest.mark.parametrize("undefined", [True, False])
def test_nested_elements_of_files(read, undefined):
    row = read({"a.dcm": nested_file(undefined=undefined)}, digest=True).first()
    assert row.error == "" and row.prefix
    found = texts(row.elements)
    assert found["root/00081140[0]/00081115[0]", "00100010"] == "DEEP^NAME"
    assert found["root/00081140[1]", "00081030"] == "second item"
    assert found["file_meta", "00020003"] == "1.2.3.1" and found["root", "00100010"] == "CHEN^SU" and found["root", "FFFCFFFC"] == ""
    assert [(b.tag, b.length) for b in row.bulk] == [("00091010", 6000), ("7FE00010", 80)]
    assert row.pixel_sha256 == hashlib.sha256(b"\x01\x02" * 40).hexdigest()


def test_encapsulated_pixels_and_broken_files(read):
    item = lambda b: struct.pack("<HHI", 0xFFFE, 0xE000, len(b)) + b
    pixels = struct.pack("<HH", 0x7FE0, 0x0010) + b"OB\0\0" + struct.pack("<I", 0xFFFFFFFF) + item(b"") + item(b"\xff" * 300) + struct.pack("<HHI", 0xFFFE, 0xE0DD, 0)
    head = file()[: file().index(struct.pack("<HH", 0x7FE0, 0x0010))]
    rows = {r.path.rsplit("/", 1)[1]: r for r in read({"ok": head + pixels + element(0xFFFCFFFC, "OB", b"\0\0"), "cut": head + pixels[:-8], "short": head[:-3], "none": b"text" * 50, "tiny": b"x"}).collect()}
    assert rows["ok"].error == "" and texts(rows["ok"].elements)["root", "FFFCFFFC"] == "" and rows["ok"].bulk[0].length == len(pixels) - 12
    assert all(rows[n].error and rows[n].elements == [] for n in ("cut", "none", "tiny"))


def test_two_gigabytes_cost_less_than_one_megabyte(spark, tmp_path):
    data = nested_file(b"")
    at = data.index(struct.pack("<HH", 0x7FE0, 0x0010))
    size = 2_000_000_000
    with open(tmp_path / "large.dcm", "wb") as f:
        f.write(data[:at] + struct.pack("<HH", 0x7FE0, 0x0010) + b"OW\0\0" + struct.pack("<I", size))
        f.seek(size, os.SEEK_CUR)
        f.write(data[at + 12 :])
    row = I.read_elements(spark, str(tmp_path)).first()
    assert row.error == "" and row.size > size and row.fetched < 1_000_000
    assert ("7FE00010", size) in [(b.tag, b.length) for b in row.bulk] and row.elements[-1].tag == "FFFCFFFC"
    assert I.read_headers(spark, str(tmp_path)).first().PatientName == "CHEN^SU"


def test_headers_by_range_equal_those_of_whole_files(spark, tmp_path):
    for i in range(6):
        (tmp_path / f"{i}.dcm").write_bytes(nested_file() if i % 2 else file(explicit=i % 3 != 0, n=i))
    (tmp_path / "bad").write_bytes(b"no header at all " * 20)
    rows = lambda whole: sorted(map(str, I.read_headers(spark, str(tmp_path), whole=whole).collect()))
    assert rows(False) == rows(True)


def test_nothing_leaks(spark, read):
    d = read({"a.dcm": nested_file(), "b.dcm": nested_file(b"", False)}, digest=True)
    d = deident.without_identity(d, "elements", ["Clinic A", "A"])
    d = deident.verify(d, "elements", "kept", ["Clinic A"], ("pixel_sha256", "pixel_sha256"))
    for r in d.collect():
        left = str(r.kept)
        assert r.problems == "" and not any(x in left for x in ("DEEP", "CHEN", "PRIVATE", "Clinic A", "19500101"))
        assert (r.counts.PatientName, r.counts.PatientBirthDate, r.counts.InstitutionName, r.counts.aliases) == (3, 1, 1, 1)
    kept = d.withColumn("kept", F.transform("kept", lambda e: e.withField("value", F.when(e["vr"] == "UI", "1").otherwise(e["value"]))))
    assert {r.problems for r in deident.verify(kept.drop("problems"), "elements", "kept", []).collect()} == {"changed"}


def test_a_center_in_the_patient_id_is_told(spark):
    d = spark.createDataFrame([([("root/00081140[0]", "00100020", "PatientID", "LO", "Clinic A 7")],)], f"elements array<{deident.ELEMENT}>")
    r = deident.without_identity(d, "elements", ["clinic a"]).first()
    assert len(r.kept) == 1 and r.counts.retained == ["root/00081140[0]/00100020"]


def test_code_for_the_name(read):
    d = read({"a.dcm": nested_file()})
    plain = texts(d.first().elements)
    by_code = lambda *tags: texts(d.select(deident.by_code(F.col("elements"), F.lit("E000007"), list(tags)).alias("e")).first().e)
    out = by_code()
    assert out["root", "00100010"] == out["root/00081140[0]/00081115[0]", "00100010"] == out["root/70051010[0]", "00100010"] == "E000007"
    assert out["root", "00080030"] == "101530" and set(out) == set(plain)
    out = by_code(*deident.tag_list("(0008,1140) (0010,0020)"))
    assert ("root", "00100020") in out and not any("00081140" in path or tag == "00081140" for path, tag in out)


def test_everything_replaced(read):
    d = read({"a.dcm": nested_file()})
    out = deident.replace_identity(F.col("elements"), F.lit("s"), "salt", F.array(F.lit("Clinic A"), F.lit("CHEN SU")), F.lit("E1"))
    found = texts(d.select(out.alias("e")).first().e)
    uid = lambda u: f"2.25.{int(hashlib.sha256(f'salt|UID|{u}'.encode()).hexdigest()[:32], 16)}"
    assert found["root", "00080018"] == found["root/00081140[0]", "00081155"] == found["file_meta", "00020003"] == uid("1.2.3.1")
    assert found["root", "0020000E"] == uid("1.2.4") + "\\" + uid("1.2.5") and found["root/00081140[0]/00081115[0]", "0020000D"] == uid("1.2.9")
    assert found["file_meta", "00020010"] == I.EXPLICIT_LE
    assert found["root/00081140[0]/00081115[0]", "00100010"] == found["root", "00100010"] == "E1" and found["root", "00100020"] == "P1"
    assert found["root", "00100030"] == "" and found["root/00081140[0]/00081115[0]", "0008103E"] == ""
    assert not any("7005" in path or tag in ("70051010", "00091010", "00101002") for path, tag in found)
    assert found["root", "00120062"] == "YES" and found["root", "00080020"] != "20240102"
