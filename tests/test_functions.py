import hashlib

import pytest
from pyspark.sql import functions as F

from studyloom.functions import dates, domain, text


def values(spark, f, items, kind="string"):
    d = spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i int, x {kind}")
    return [r[0] for r in d.orderBy("i").select(f(F.col("x"))).collect()]


def test_patient_id(spark):
    uuid = "12345678-1234-1234-1234-123456789ABC"
    assert values(spark, text.patient_id, [f"P1!{uuid}", "P1!1234", f"!{uuid}", " P2 ", None]) == ["P1", "P1!1234", f"!{uuid}", "P2", ""]


def test_names(spark):
    got = values(spark, text.parse_name, ["WANG XIAOMING M-56Y^^^^", "CHEN^SU^FANG", "LI 7Y F", "Ｌｉ　Ｌｅｉ", "", None, "A M-1000Y"])
    assert [tuple(r) for r in got] == [("WANG XIAOMING", "M", "056Y"), ("CHEN SU FANG", "", ""), ("LI", "F", "007Y"), ("Li Lei", "", ""), ("", "", ""), ("", "", ""), ("A M-1000Y", "", "")]
    assert values(spark, text.name_key, ["Wang  Xiao-Ming", "UNKNOWN", "无名氏", "ＡＢ1"]) == ["wangxiaoming", "", "", "ab1"]
    assert values(spark, text.bare_name, ["Chen^Su Fang"]) == ["chensufang"]
    assert values(spark, lambda c: text.nfkc(c), ["ﬁ①", None]) == ["fi1", None]


def test_identifiers(spark):
    assert values(spark, text.identifier_key, ["123.0", " 0 1A", "1.50", None]) == ["123", "01a", "1.50", ""]
    assert values(spark, text.screening_number, ["15_H001", "01-X001", "7-q12", "x15_H001", None]) == ["15-H001", "", "7-Q12", "", ""]
    assert values(spark, text.short_screening, ["01-H1", "00-H2"]) == ["1-H1", "0-H2"]
    assert values(spark, text.code_text, [7, 123, 1234, 0, -1, None], "int") == ["007", "123", "1234", None, None, None]
    assert values(spark, text.sop_text, ["NA", "n/a", "1.2", "/", None]) == ["", "", "1.2", "", ""]
    assert values(spark, text.number_text, [3.0, 2.5, float("nan"), None], "double") == ["3", "2.5", "", ""]


def test_paths_and_keys(spark):
    assert values(spark, text.path_component, ["a/b:c", "x. . ", "CON.txt", "", "y" * 200]) == ["a_b_c", "x", "_CON.txt", "UNKNOWN", "y" * 180]
    assert values(spark, text.center_key, ["Center （A）_1-2"]) == ["centera12"]
    assert values(spark, lambda c: text.institution_key(c, {"joint": ("north", "south")}), ["North & South", "North"]) == ["joint", "north"]
    assert values(spark, text.path_hash, ["a\\b"]) == [hashlib.sha256(b"a/b").hexdigest()]
    keys = values(spark, text.natural_key, ["a10", "a9", "a09", "b1", "1-H2", "1-H10"])
    assert keys[1] == keys[2] < keys[0] < keys[3] and keys[4] < keys[5]
    assert values(spark, text.cjk_name, ["01_王长平_x", "患者", "none"]) == ["王长平", "", ""]
    d = spark.createDataFrame([("root/术前/王小明/P1_李四", "P1"), ("a/b", "")], "p string, i string")
    assert [r[0] for r in d.select(text.path_name(F.col("p"), F.col("i"))).collect()] == ["李四", ""]


def test_initials(spark):
    d = spark.createDataFrame([("WANG CHANGPING", "WCP"), ("WANG PINGCHANG", "WCP"), ("XWANG", "W"), ("AB", "AB")], "n string, i string")
    assert [r[0] for r in d.select(text.initials_match(F.col("n"), F.col("i"))).collect()] == [True, False, False, True]


def test_pinyin(spark):
    assert values(spark, lambda c: text.pinyin_initials(c), ["王长平", "Aé啊", "", None, "王龘平", "龘"]) == ["WCP", "A", "", "", "", ""]
    d = spark.createDataFrame([("王长平", "WANG CHANGPING"), ("王长平", "WANG PINGCHANG")], "n string, h string")
    assert [r[0] for r in d.select(text.chinese_matches_header(F.col("n"), F.col("h"))).collect()] == [True, False]


def test_lists_and_guards(spark):
    assert values(spark, text.image_type, ["ncct_CTP x", "dsa CTTP", "scan"]) == ["CT+CTP", "DSA+CTP", "REVIEW"]
    d = spark.createDataFrame([("b、a", "c|a")], "x string, y string")
    assert d.select(text.merge_joined(F.col("x"), F.col("y"))).first()[0] == "a、b、c"
    assert values(spark, text.csv_guard, ["=1", " +x", "a=b", "@c", ""]) == ["'=1", "' +x", "a=b", "'@c", ""]
    assert values(spark, text.is_yes, ["是", "Yes", "no", None]) == [True, True, False, False]
    assert values(spark, lambda c: text.replace_identity(c, ["Li", "Li Lei", "a.b"], F.lit("E1")), ["of LI LEI, a.b and axb"]) == ["of E1, E1 and axb"]


def test_dates(spark):
    assert [str(x) if x else None for x in values(spark, dates.valid_date, ["20250230", "2024-02-29", "202401", "20240101123000", "", None])] == [None, "2024-02-29", None, "2024-01-01", None, None]
    assert [str(x) if x else None for x in values(spark, dates.table_date, ["45000", "2024/3/5", "2024.03.05", "20240305", "x", None])] == ["2023-03-15", "2024-03-05", "2024-03-05", "2024-03-05", None, None]
    assert [str(x) for x in values(spark, dates.date_token, ["scan_2024-03-05_b", "120240305"])] == ["2024-03-05", "None"]
    d = spark.sql("SELECT stack(5, -1, 0, 1, 185, cast(null as int)) AS x")
    assert [r[0] for r in d.select(dates.period(F.date_add(F.lit("2024-01-01").cast("date"), F.col("x")), F.lit("2024-01-01").cast("date"))).collect()] == ["术前", "术中", "0.03", "6.17", None]
    assert values(spark, dates.age_years, ["056Y", "006M", "073D", "x", None]) == [56.0, 0.5, pytest.approx(73 / 365.25), None, None]
    assert values(spark, dates.without_fraction, ["101530.250", "1015"]) == ["101530", "1015"]
    assert values(spark, dates.period_months, ["6", "术后6个月", "术中", ""]) == [6.0, 6.0, None, None]


def test_shift_and_remap(spark):
    h = int(hashlib.sha256(b"s|DATE|P1").hexdigest()[:8], 16)
    days = h % 3651 * (1 if h % 2 else -1)
    assert values(spark, lambda c: dates.shift_days(c, "s"), ["P1"]) == [days]
    assert values(spark, lambda c: dates.shifted(c, F.lit(30)), ["20240115", "x"]) == ["20240214", "x"]
    assert values(spark, lambda c: dates.remap_uid(c, "s"), ["1.2", ""]) == [f"2.25.{int(hashlib.sha256(b's|UID|1.2').hexdigest()[:32], 16)}", ""]


def test_domain(spark):
    assert values(spark, domain.modality, ["mri", "XA "]) == ["MR", "XA"]
    assert values(spark, domain.sex, ["f", "O", ""]) == ["F", "", ""]
    d = spark.createDataFrame([(["OT", "CT", "XA"], True), (["MR", "CT"], False), ([], False)], "m array<string>, t boolean")
    assert [r[0] for r in d.select(domain.display_type(F.col("m"), F.col("t"))).collect()] == ["XA（含3D_DSA断层）、CT、OT", "CT、MR", "其他/未知"]
    assert values(spark, domain.uid_reasons, ["1.2.3", "1.02", "", "1..2", "1." + "2" * 70]) == [[], ["leading_zero"], ["missing"], ["format"], ["length"]]
    assert values(spark, domain.path_unsafe, ["a", "a/b", "..", "x. ", "y" * 241]) == [False, True, True, True, True]


def test_identity_goes_whatever_its_case(spark):
    from studyloom.operators import deident

    e = "named_struct('path', '', 'tag', '00081030', 'keyword', 'StudyDescription', 'vr', 'LO', 'value', "
    d = spark.sql(f"SELECT array({e}'of SMITH JOHN, smith (a.b) and SMITH (A.B), axb Müller MÜLLER'), {e}CAST(NULL AS STRING))) AS elements, 'p' AS id")
    out = deident.shift_and_scrub(F.col("elements"), F.col("id"), "salt", F.array(F.lit("Smith"), F.lit("smith (a.b)"), F.lit("a.b"), F.lit("Smith John"), F.lit(""), F.lit(None), F.lit("müller")), F.lit(r"C$1\2"))
    row = d.select(out.alias("x")).first().x
    c = r"C$1\2"
    assert row[0].value == f"of {c}, {c} and {c}, axb {c} {c}" and row[1].value is None


def test_placeholder_names(spark):
    assert values(spark, text.name_key, ["Anonymized", "ANONYMOUS", "Ann Onym"]) == ["", "", "annonym"]


def test_names_of_paths_and_roots(spark):
    from studyloom.functions import text

    rows = [("a/王明/P7_张三/x", "p7", "李四", "HE^ADER"), ("a/王明/x", "p7", "李四", ""), ("a/b", "p7", "no name", "WANG^LI "), ("a/王明", "", "李四五六七八九十", "")]
    d = spark.createDataFrame(rows, "path string, id string, root string, header string")
    got = d.select(text.path_name(d.path, d.id, d.root, d.header).alias("a"), text.owned_name(d.path, d.id, d.root).alias("b"), text.path_name(d.path, d.id).alias("c")).collect()
    assert [tuple(r) for r in got] == [("张三", "张三", "张三"), ("李四", "", "王明"), ("WANG LI", "", ""), ("李四五六七八九十", "", "王明")]
    kinds = spark.createDataFrame([("脑灌注 血管",), ("数字减影血管",), ("平扫CTA",), ("x",)], "n string")
    assert [r[0] for r in kinds.select(text.image_type(kinds.n)).collect()] == ["CTP+CTA", "CTA+DSA", "CTA", "REVIEW"]
