"""Replacement of identity finds each value once, in both of its forms."""

import random

import pytest
from pyspark.sql import functions as F

from studyloom.functions import dates
from studyloom.operators import deident


@pytest.mark.parametrize("generated", [False, True])
def test_decimals_of_128_bits(spark, generated):
    random.seed(4)
    values = [0, 1, 10**9 - 1, 10**9, 10**18 - 1, 10**18, 10**27 - 1, 10**27, 10**36, (1 << 128) - 1, *(random.getrandbits(n) for n in range(1, 129))]
    d = spark.createDataFrame([(f"{v:032x}" + "f" * 32, str(v)) for v in values], "digits string, want string")
    assert d.where(~dates.decimal_text(F.col("digits"), generated).eqNullSafe(F.col("want"))).collect() == []


def test_an_identifier_is_hashed_once(spark):
    d = spark.range(3).select(F.col("id").cast("string").alias("u"))
    plan = lambda c: d.select(c.alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    inside = F.transform(F.array("u"), lambda u: dates.remap_uid(u, "salt"))
    assert plan(inside).count("sha2(") == 1
    assert plan(F.transform(F.array("u"), lambda u: dates.shift_days(u, "salt"))).count("sha2(") == 1


def test_elements_as_columns_equal_those_of_an_array(spark):
    rows = [
        ("root", "00100010", "PatientName", "PN", "LI^LEI"), ("root", "00100030", "PatientBirthDate", "DA", "19500101"), ("root", "00080020", "StudyDate", "DA", "20240131"), ("root", "0008002A", "AcquisitionDateTime", "DT", "20240131101530"),
        ("root", "0020000D", "StudyInstanceUID", "UI", "1.2"), ("root", "0020000E", "SeriesInstanceUID", "UI", "1.2\\1.3\\"), ("root", "00080018", "SOPInstanceUID", "UI", ""), ("root", "00080016", "SOPClassUID", "UI", "1.9"),
        ("root", "00081140", "x", "LO", "Li Lei and LI LEI at $1"), ("root", "00081141", "x", "LO", None), ("root", "00091001", "", "LO", "private"), ("root/70051010[0]", "00100010", "PatientName", "PN", "in private"),
        ("root/00081140[0]/00101002[1]", "00081141", "x", "LO", "in emptied"), ("root/00081140[0]", "0020000D", "StudyInstanceUID", "UI", "1.2"), ("root", "00120062", "PatientIdentityRemoved", "CS", "NO"), ("root", "0040A160", "TextString", "UT", "gone"),
    ]
    names = ("path", "tag", "keyword", "vr", "value")
    for some in (rows, rows[1:]):
        d = spark.createDataFrame([(some, "s", "E$1")], f"elements array<{deident.ELEMENT}>, subject string, code string")
        how = (F.col("subject"), "salt", F.array(F.lit("li lei"), F.lit("li")), F.col("code"))
        columns = [F.struct(*[F.lit(v).cast("string").alias(n) for n, v in zip(names, r, strict=True)]) for r in some]
        array, constant = d.select(deident.replace_identity(F.col("elements"), *how), F.array_compact(F.array(*deident.replace_identity_of(columns, *how)))).first()
        text = lambda e: tuple(map(tuple, e))
        root = [e for e in text(array) if e[1] == "00100010"]
        assert sorted(text(array), key=str) == sorted(text(constant), key=str)
        assert root == [("root", "00100010", "PatientName", "PN", "E$1")] and len(array) == len(rows) - 3
