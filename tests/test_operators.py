"""Row-level cases of operators that queries over the given tables do not reach."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from studyloom.operators import deident, files, identity, matching, selection, state
from studyloom.operators.components import connected_components


@pytest.mark.parametrize("n, edges", [(30, 25), (200, 150), (120, 400)])
def test_components(spark, n, edges):
    rnd = random.Random(n)
    pairs = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(edges)] + [(i, i + 1) for i in range(1000, 1060)] + [(5, None), (7, 7)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(pairs, "a int, b int")).collect()}
    parent = {x: x for p in pairs for x in p if x is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if b is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    linked = {x for a, b in pairs if b is not None and a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "a string, b string")).collect() == []


PERSON = "patient_id string, name_key string, birth_date date, sex string, birth_year double, institutions array<string>"


def related(spark, *people):
    import datetime

    rows = [(p, n, datetime.date(int(b), 1, 1) if b else None, s, y, i) for p, n, b, s, y, i in people]
    df = spark.createDataFrame(rows, PERSON)
    return df, {(r.left_id, r.right_id): r.relation for r in identity.pairs(df).collect()}


def test_relations(spark):
    _, got = related(
        spark, ("a", "n", 1950, "M", None, ["x"]), ("b", "n", 1950, "M", None, ["y"]), ("c", "n", 1951, "M", None, ["x"]), ("d", "n", 1950, "F", None, ["x"]), ("e", "n", None, "", 1960.0, ["x"]),
        ("f", "n", None, "", 1958.0, ["z"]), ("g", "other", 1950, "M", None, ["x"]), ("h", "", 1950, "M", None, ["x"]),
    )
    assert got[("a", "b")] == "confirmed" and got[("a", "c")] == "review_group" and got[("b", "c")] == "conflict" and got[("a", "d")] == "conflict"
    assert got[("a", "e")] == "possible" and got[("e", "f")] == "conflict" and not any("g" in k or "h" in k for k in got)


def test_conflict_vetoes_a_confirmed_merge(spark):
    people = spark.createDataFrame([(p, "n") for p in "abcd"], "patient_id string, name_key string")
    pairs = spark.createDataFrame([("a", "b", "confirmed"), ("b", "c", "confirmed"), ("a", "c", "conflict"), ("c", "d", "review_group")], "left_id string, right_id string, relation string")
    got = {r.patient_id: r.group_id for r in identity.groups(people, pairs).collect()}
    assert got == {"a": "a", "b": "a", "c": "c", "d": "c"}


def test_group_keys_continue(spark):
    grouped = spark.createDataFrame([("a", "x", "a"), ("b", "x", "a"), ("c", "y", "c"), ("d", "z", "d")], "patient_id string, name_key string, group_id string")
    old = spark.createDataFrame([("b", "G000007"), ("gone", "G000009")], "patient_id string, group_key string")
    got = {r.patient_id: r.group_key for r in identity.group_keys(grouped, old).collect()}
    assert got == {"a": "G000007", "b": "G000007", "c": "G000010", "d": "G000011"}


def test_ledger_faults(spark):
    d = spark.createDataFrame([("c", "1-H1", 1), ("c", "1-H2", 1), ("c", "1-H3", 2), ("d", "1-H1", 1)], "center string, screening string, number long")
    assert sorted(r.screening for r in identity.ledger_faults(d).collect()) == ["1-H1", "1-H2"]


def test_visits(spark):
    cases = {"3": "6M", "6": "6M", "8.999": "6M", "术后6个月": "6M", "9": "12M", "15": "12M", "15.01": "12M_CANDIDATE", "18.4": "12M_CANDIDATE", "2.99": "PENDING", "-1": "PENDING", "": "PENDING"}
    rows = [(k, k) for k in cases] + [("x", "术中"), ("x", "6"), ("y", "6"), ("y", "12"), ("z", "11.98"), ("z", "12.01"), ("w", "11"), ("w", "12")]
    got = {r.s: r.visit for r in selection.classify(spark.createDataFrame(rows, "s string, period string"), ["s"]).collect()}
    assert got == cases | {"x": "PENDING", "y": "PENDING", "z": "12M", "w": "PENDING"}


def test_nearest_visit(spark):
    rows = [("a", 1, "12M", 12.0), ("a", 2, "12M_CANDIDATE", 19.0), ("b", 3, "12M_CANDIDATE", 18.4), ("c", 4, "12M", 10.0), ("c", 5, "12M", 14.0), ("d", 6, "6M", 6.0), ("d", 7, "PENDING", None)]
    got = {r.s: r.status for r in selection.nearest_visit(spark.createDataFrame(rows, "p string, s int, visit string, months double"), ["p"]).collect()}
    assert got == {1: "selected", 2: "not_selected", 3: "selected", 4: "tied", 5: "tied", 6: "matched", 7: "pending"}


def test_match_falls_back_only_without_name(spark):
    import datetime

    day = datetime.date(2024, 1, 1)
    reg = spark.createDataFrame(
        [(1, "c", "n1", "h1", day, "1-H1"), (2, "c", "n2", "h2", day, "1-H2"), (3, "c", "n2", "h3", day, "1-H3"), (4, "c", "n4", "h4", day, "1-H4"), (5, "c", "n4", "h4", day, "1-H4")],
        "source_order long, center_name string, name_key string, hospital_number string, surgery_date date, screening_key string",
    )
    f = spark.createDataFrame([("n1", ""), ("n2", "1-H2"), ("no", "1-H3"), ("no", "9-H9"), ("n4", ""), ("no", "")], "name string, number string")
    got = sorted((r.name, r.number, r.match, r.hospital_number) for r in matching.match_registry(f, reg, "name", "number").collect())
    assert got == sorted([("n1", "", "name", "h1"), ("n2", "1-H2", "ambiguous_name", None), ("no", "1-H3", "screening_number", "h3"), ("no", "9-H9", "missing", None), ("n4", "", "name", "h4"), ("no", "", "missing", None)])


def test_copy_status(spark):
    rows = [("p1", "t/a.dcm", "s" * 20), ("p2", "t/a.dcm", "s" * 20), ("p3", "t/a.dcm", "z" * 20), ("p4", "t/a.dcm", "z" * 20), ("p5", "_quarantine/x.dcm", "s")]
    got = {r.relative_path: (r.status, r.final_target) for r in files.copy_status(spark.createDataFrame(rows, "relative_path string, target string, sha string")).collect()}
    assert got["p1"] == ("copied", "t/a.dcm") and got["p2"][0] == "duplicate_same" and got["p3"] == ("conflict", "t/a." + "z" * 12 + ".conflict.dcm")
    assert got["p4"][0] == "duplicate_same" and got["p5"][0] == "quarantined"


STUDY = "study_uid string, patient_ids string, modalities string, exam_date string, has_3d int, confidence int, series_count long, file_count long, evidence string, rule_version string"


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([("s1", "P1", "CT", "2024-01-02", 1, 82, 2, 5, "A | B", "1"), ("s2", "P2", "XA", None, 0, 72, 1, 1, "A", "1")], STUDY)
    new = spark.createDataFrame([("s1", "P1、P3", "XA", "2024-01-01", 0, 72, 3, 4, "B", "2"), ("s3", "P4", "MR", None, 0, 99, 1, 1, "C", "2")], STUDY)
    once = state.upsert_studies(old, new)
    rows = {r.study_uid: r for r in once.collect()}
    assert tuple(rows["s1"]) == ("s1", "P1、P3", "CT、XA", "A、B", "2024-01-01", 0, 72, 3, 5, "2", "merged")
    assert rows["s2"].action == "kept" and rows["s3"].action == "added"
    twice = state.upsert_studies(once.drop("action"), new)
    assert sorted(r[:-1] for r in twice.collect()) == sorted(r[:-1] for r in once.collect())


def test_verification_finds_what_is_left(spark):
    e = deident.ELEMENT
    rows = [([("root", "00100020", "PatientID", "LO", "P1"), ("root", "00100010", "PatientName", "PN", "N")], [("root", "00100020", "PatientID", "LO", "P2"), ("root", "00100010", "PatientName", "PN", "Clinic A")])]
    d = spark.createDataFrame(rows, f"b array<{e}>, a array<{e}>")
    assert deident.verify(d, "b", "a", ["clinic a"]).first().problems == "changed,identity_left,center_named"
    assert deident.verify(d, "b", "b", ["clinic a"]).first().problems == "identity_left"
    kept, counts = deident.remove_identity(F.col("a"), ["clinic a"])
    r = d.select(kept.alias("k"), counts.alias("n")).first()
    assert [x.keyword for x in r.k] == ["PatientID"] and r.n.PatientName == 1


def test_ids_that_contradict_themselves_are_merged_with_none(spark):
    from studyloom.operators import identity

    schema = "patient_id string, name_key string, birth_date date, sex string, birth_year double, institutions array<string>, internal_conflicts string"
    same = ("ann", None, "F", None, ["x"])
    people = spark.createDataFrame([("a", *same, ""), ("b", *same, ""), ("c", *same, "multiple_birth_dates"), ("d", *same, "multiple_birth_dates,multiple_sexes")], schema)
    found = {(r.left_id, r.right_id): (r.relation, r.conflicts) for r in identity.pairs(people).collect()}
    assert found["a", "b"] == ("confirmed", "")
    assert found["a", "c"] == ("conflict", "multiple_birth_dates")
    assert found["c", "d"] == ("conflict", "multiple_birth_dates,multiple_sexes")
    related = identity.pairs(people)
    groups = {r.patient_id: r.group_id for r in identity.groups(people, related).collect()}
    assert groups == {"a": "a", "b": "a", "c": "c", "d": "d"}


def test_earlier_groups_stay_together(spark):
    from studyloom.operators import identity

    people = spark.createDataFrame([(p, "n") for p in "abcde"], "patient_id string, name_key string")
    pairs = spark.createDataFrame(
        [("a", "b", "conflict", "", "sex"), ("b", "c", "confirmed", "x,y", ""), ("a", "c", "possible", "x", ""), ("a", "d", "conflict", "", "sex"), ("b", "d", "confirmed", "x,y", "")],
        "left_id string, right_id string, relation string, evidence string, conflicts string",
    )
    old = spark.createDataFrame([("a", "G000001"), ("b", "G000001"), ("gone", "G000002"), ("e", "G000002")], "patient_id string, group_key string")
    grouped = identity.groups(people, pairs, old)
    assert {r.patient_id: r.group_id for r in grouped.collect()} == {"a": "a", "b": "a", "c": "a", "d": "d", "e": "e"}
    drifts = spark.createDataFrame([("c", "sex"), ("d", "")], "patient_id string, drift string")
    got = {(r.left_id, r.right_id): (r.status, r.basis) for r in identity.review_rows(pairs, grouped, drifts).collect()}
    assert got["b", "d"] == ("mapping_conflict", "x,y") and got["b", "c"] == ("auto_resolved", "x,y")
    assert got["c", "c"] == ("mapping_drift", "sex") and ("d", "d") not in got


def test_subject_gate_wants_two_facts_in_common(spark):
    from studyloom.operators import identity

    rows, day = [], datetime.date(2020, 1, 1)
    add = lambda who, study, name="n", born=None, sex="", age="", place="": rows.append((who, study, name, born, sex, age, day, place))
    add("place", "1", sex="M", place="x"), add("place", "2", age="050Y", place="x")
    add("none", "1", sex="M", place="x"), add("none", "2", age="050Y", place="y")
    add("age", "1", sex="M", age="050Y"), add("age", "2", age="050Y")
    add("bare", "1", place="x"), add("bare", "2", place="x")
    add("sex", "1", sex="M"), add("sex", "2", sex="F")
    add("one", "1", sex="M")
    add("nameless", "1", name="", sex="M")
    schema = "patient_id string, study_uid string, name_key string, birth_date date, sex string, suffix_age string, exam_date date, institution_key string"
    got = {r.patient_id: r.decision for r in identity.subject_gate(spark.createDataFrame(rows, schema)).collect()}
    assert got == {"place": "confirmed", "none": "insufficient", "age": "confirmed", "bare": "insufficient", "sex": "conflict", "one": "confirmed", "nameless": "insufficient"}


def test_image_type_lists_and_period_rules(spark):
    from studyloom.functions import domain
    from studyloom.operators import selection

    values = [["A", "B C"], ["it's"], ['it\'s "x"', "a\\b"], [], None]
    d = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v array<string>")
    got = [r.t for r in d.orderBy("i").select(domain.image_type(F.col("v")).alias("t")).collect()]
    assert got == [str(v) if v is not None else "" for v in values]
    rows = [("术前 ", "1.2", "1.2.3"), ("术中", "1.2", " N/A"), ("术中", None, None), ("术后", "1", "2"), (None, "1", "2")]
    got = selection.period_rules(spark.createDataFrame(rows, "period string, series_uid string, sop_uid string")).collect()
    assert sorted((r.period, r.selector_field, r.selector_uid) for r in got) == sorted([("术前", "SeriesInstanceUID", "1.2"), ("术中", "SOPInstanceUID", ""), ("术中", "SOPInstanceUID", "")])


def test_centers_by_alias_part_only_one_and_names(spark):
    centers = spark.createDataFrame([("northhospital", ["a", "b", "c"]), ("southhospital", ["d", "e"]), ("eastclinic", ["a", "b"])], "center_key string, names array<string>")
    rows = [("North Hospital", []), ("south", []), ("hospital", ["d", "e"]), ("x", ["a", "b"]), ("y", ["a", "b", "c"]), ("Known", []), ("Unknown", ["d", "e"])]
    folders = spark.createDataFrame(rows, "folder string, names array<string>")
    aliases = spark.createDataFrame([("Known", "East Clinic"), ("Unknown", "no such center")], "folder string, center string")
    got = {r.folder: (r.center_key, r.basis) for r in matching.resolve_centers(folders, centers, aliases).collect()}
    assert got["North Hospital"] == ("northhospital", "exact") and got["south"] == ("southhospital", "substring")
    assert got["hospital"] == ("southhospital", "names") and got["x"] == (None, "unresolved") and got["y"] == ("northhospital", "names")
    assert got["Known"] == ("eastclinic", "alias") and got["Unknown"] == (None, "alias_unknown")
    one = matching.resolve_centers(folders, centers.where("center_key = 'eastclinic'"))
    assert {(r.center_key, r.basis) for r in one.collect()} == {("eastclinic", "only_center")}


def test_report_tells_of_disagreeing_files(spark):
    cols = "study_uid string, series_uid string, sop_uid string, frames int, acquisition_date date, study_date date, series_date date, modality string, series_description string, screening string, patient_name string, patient_id string, primary_angle string"
    import datetime

    day = datetime.date(2024, 1, 2)
    rows = [
        ("1", "1", "1", None, None, None, day, "XA", "d", "01-H001", "LI", "a", "10"), ("1", "1", "1", None, None, None, day, "XA", "d", "01-H002", "WU", "b", "10"), ("1", "1", "2", None, None, None, None, "XA", "d", "01-H002", "L I", "a", ""),
        ("1", "2", "3", 8, None, day, None, "XA", "d", "", "", "", "10"), ("1", "2", "4", 8, day, None, None, "XA", "d", "", "", "", "20"),
    ]
    reg = spark.createDataFrame([(1, "li", "", "h", day, "x"), (2, "q", "01-H002", "g", day, "x"), (3, "q", "01-H002", "g", day, "y")], "source_order int, name_key string, screening_key string, hospital_number string, surgery_date date, patient_initials string")
    report = matching.series_report(spark.createDataFrame(rows, cols), reg)
    got = {(r.series_uid, r.instance): r for r in report.collect()}
    first = got["1", ""]
    assert (first.date_kind, first.screening, first.files, first.instances, first.primary_angle) == ("series_date", "01-H002", 3, 2, "10")
    assert got["2", "3"].date_kind == "study_date" and len(got) == 3
    why = {(r.series_uid, r.reason) for r in matching.report_exceptions(report).collect()}
    assert why == {("1", "several_names"), ("1", "several_screening_numbers"), ("1", "several_patient_ids"), ("1", "repeated_instances"), ("2", "missing")}
    assert first.match == "name" and first.hospital_number == "h"
    # initials tell two subjects of one number apart
    by_number = matching.match_registry(spark.createDataFrame([("zz", "01-H002")], "name string, number string"), reg, "name", "number")
    assert by_number.first().match == "ambiguous_screening_number"
