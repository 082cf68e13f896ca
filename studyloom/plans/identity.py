"""Queries over patient identity."""

from __future__ import annotations

from pyspark.sql import functions as F

from studyloom.functions import text
from studyloom.operators import headers as H
from studyloom.operators import identity as I
from studyloom.plans.adapters import hdr, oracle, registry
from studyloom.storage import staged


def _nh(spark, sf):
    return H.normalised(hdr(spark, sf))


# counted over values of one kind at a time: the commonest, the least of equals
_MODE = """{0} AS (SELECT patient_id, first(v ORDER BY n DESC, v) AS v, count(*) AS k FROM (SELECT patient_id, {1} AS v, count(*) AS n FROM pm WHERE {1} <> '' GROUP BY ALL) GROUP BY 1)"""
_KEY = "lower(regexp_replace({0}, '[^A-Za-z0-9]', '', 'g'))"
PROFILES = f"""
pm AS (SELECT *, CAST(birth_date AS VARCHAR) AS bd_text, year(exam_date) - CAST(substr(CASE WHEN age <> '' THEN age ELSE suffix_age END, 1, 3) AS DOUBLE) AS by_age,
 age <> '' AND suffix_age <> '' AND abs(CAST(substr(age, 1, 3) AS INT) - CAST(substr(suffix_age, 1, 3) AS INT)) > 1 AS age_apart, sex <> '' AND suffix_sex <> '' AND sex <> suffix_sex AS sex_apart
 FROM (SELECT * REPLACE (nullif(age, '') AS age, nullif(suffix_age, '') AS suffix_age) FROM nh) WHERE patient_id <> ''),
{_MODE.format("tn", "folder_name")}, {_MODE.format("hn", "patient_name")}, {_MODE.format("rn", "patient_name_raw")}, {_MODE.format("bd", "bd_text")}, {_MODE.format("sx", "sex")},
b0 AS (SELECT patient_id, count(*) AS files, count(DISTINCT study_uid) AS studies, list_sort(list(DISTINCT institution_key)) AS institutions, list_sort(list(DISTINCT source_subject)) AS sources,
 median(by_age) AS birth_year, max(by_age) - min(by_age) AS span, bool_or(coalesce(age_apart, false)) AS age_apart, bool_or(coalesce(sex_apart, false)) AS sex_apart FROM pm GROUP BY 1),
prof AS (SELECT b0.patient_id, coalesce(tn.v, hn.v, '') AS canonical_name, {_KEY.format("coalesce(tn.v, hn.v, '')")} AS name_key, coalesce(hn.v, '') AS header_name, {_KEY.format("coalesce(hn.v, '')")} AS header_key,
 coalesce(rn.v, '') AS raw_name, CAST(bd.v AS DATE) AS birth_date, coalesce(sx.v, '') AS sex, birth_year, institutions, sources, studies, files,
 concat_ws(',', CASE WHEN span > 1.25 THEN 'age' END, CASE WHEN abs(year(CAST(bd.v AS DATE)) - birth_year) > 1.25 THEN 'age_vs_birth_date' END, CASE WHEN bd.k > 1 THEN 'birth_date' END, CASE WHEN sx.k > 1 THEN 'sex' END,
  CASE WHEN age_apart THEN 'suffix_age' END, CASE WHEN sex_apart THEN 'suffix_sex' END) AS internal_conflicts
 FROM b0 LEFT JOIN tn USING (patient_id) LEFT JOIN hn USING (patient_id) LEFT JOIN rn USING (patient_id) LEFT JOIN bd USING (patient_id) LEFT JOIN sx USING (patient_id))"""
PAIRS = (
    PROFILES
    + """,
p1 AS (SELECT l.patient_id AS left_id, r.patient_id AS right_id, CASE WHEN l.name_key <> '' AND l.name_key = r.name_key THEN 'canonical_name' ELSE 'header_patient_name' END AS basis,
 CASE WHEN l.name_key <> '' AND l.name_key = r.name_key THEN l.name_key ELSE l.header_key END AS name_key,
 concat_ws(',', CASE WHEN l.birth_date = r.birth_date THEN 'birth_date' END, CASE WHEN l.sex <> '' AND l.sex = r.sex THEN 'sex' END,
  CASE WHEN list_has_any(l.institutions, r.institutions) THEN 'institution' END, CASE WHEN abs(l.birth_year - r.birth_year) <= 1.25 THEN 'age' END) AS evidence,
 list_filter([CASE WHEN l.birth_date <> r.birth_date THEN 'birth_date' END, CASE WHEN l.sex <> '' AND r.sex <> '' AND l.sex <> r.sex THEN 'sex' END, CASE WHEN abs(l.birth_year - r.birth_year) > 1.25 THEN 'age' END]
  || string_split(l.internal_conflicts, ',') || string_split(r.internal_conflicts, ','), lambda x: x <> '') AS c
 FROM prof l JOIN prof r ON l.patient_id < r.patient_id AND ((l.name_key <> '' AND l.name_key = r.name_key) OR (l.header_key <> '' AND l.header_key = r.header_key))),
p0 AS (SELECT *, coalesce(array_to_string(list_sort(list_distinct(c)), ','), '') AS conflicts FROM p1),
prs AS (SELECT left_id, right_id, name_key, basis, CASE WHEN conflicts = 'birth_date' AND evidence LIKE '%sex%' AND evidence LIKE '%institution%' THEN 'review_group'
 WHEN conflicts <> '' THEN 'conflict' WHEN evidence LIKE '%,%' THEN 'confirmed' ELSE 'possible' END AS relation, evidence, conflicts FROM p0)"""
)


def a07_identity_profiles(spark, sf):
    p = I.profiles(_nh(spark, sf))
    return p.withColumns({"birth_date": F.col("birth_date").cast("string"), "institutions": F.array_join("institutions", ","), "sources": F.array_join("sources", ",")})


A07 = f"WITH {PROFILES} SELECT * REPLACE (CAST(birth_date AS VARCHAR) AS birth_date, array_to_string(institutions, ',') AS institutions, array_to_string(sources, ',') AS sources) FROM prof"


def a06_identity_evidence(spark, sf):
    nh = _nh(spark, sf)
    return I.add_evidence(I.evidence(nh.where("file_size % 3 = 0")), I.evidence(nh.where("file_size % 3 = 1")), I.evidence(nh.where("file_size % 3 = 2")))


A06 = f"""WITH {PROFILES}, kinds AS (SELECT patient_id, unnest([{{'kind': 'file', 'value': '-'}}, {{'kind': 'trusted_name', 'value': folder_name}}, {{'kind': 'header_name', 'value': patient_name}}, {{'kind': 'raw_name', 'value': patient_name_raw}},
 {{'kind': 'birth_date', 'value': bd_text}}, {{'kind': 'sex', 'value': sex}}, {{'kind': 'institution', 'value': institution_key}}, {{'kind': 'birth_year', 'value': CAST(by_age AS VARCHAR)}}, {{'kind': 'source', 'value': source_subject}},
 {{'kind': 'study', 'value': study_uid}}, {{'kind': 'conflict', 'value': CASE WHEN sex_apart THEN 'suffix_sex' END}}, {{'kind': 'conflict', 'value': CASE WHEN age_apart THEN 'suffix_age' END}}]) AS t FROM pm)
SELECT patient_id, t.kind AS kind, t.value AS value, count(*) AS n FROM kinds WHERE t.value <> '' GROUP BY ALL"""


def a08_dominant_patient(spark, sf):
    return I.dominant_ids(_nh(spark, sf))


A08 = """WITH n AS (SELECT source_subject, patient_id, count(DISTINCT study_uid) AS s, count(*) AS f FROM nh WHERE patient_id <> '' GROUP BY 1, 2),
r AS (SELECT *, rank() OVER (PARTITION BY source_subject ORDER BY s DESC, f DESC) AS k FROM n)
SELECT source_subject, min(patient_id) AS patient_id FROM r WHERE k = 1 GROUP BY 1 HAVING count(*) = 1"""


def a09_set_profiles(spark, sf):
    p = I.set_profiles(_nh(spark, sf), "study_uid")
    return p.select("study_uid", "files", *[F.array_join(c, ",").alias(c) for c in ("patient_ids", "names", "birth_dates", "sexes", "institutions")])


A09 = """SELECT study_uid, count(*) AS files, coalesce(string_agg(DISTINCT nullif(patient_id, ''), ',' ORDER BY nullif(patient_id, '')), '') AS patient_ids,
coalesce(string_agg(DISTINCT nullif(name_key, ''), ',' ORDER BY nullif(name_key, '')), '') AS names,
coalesce(string_agg(DISTINCT CAST(birth_date AS VARCHAR), ',' ORDER BY CAST(birth_date AS VARCHAR)), '') AS birth_dates,
coalesce(string_agg(DISTINCT nullif(sex, ''), ',' ORDER BY nullif(sex, '')), '') AS sexes,
coalesce(string_agg(DISTINCT nullif(institution_key, ''), ',' ORDER BY nullif(institution_key, '')), '') AS institutions FROM nh GROUP BY 1"""


def e01_identity_pairs(spark, sf):
    return I.pairs(I.profiles(_nh(spark, sf)))


E01 = f"WITH {PAIRS} SELECT * FROM prs"


def e03_subject_gate(spark, sf):
    return I.subject_gate(_nh(spark, sf))


E03 = """WITH s AS (SELECT patient_id, study_uid, min(nullif(name_key, '')) AS nk, min(birth_date) AS bd, min(nullif(sex, '')) AS sx,
count(DISTINCT nullif(name_key, '')) AS a, count(DISTINCT birth_date) AS b, count(DISTINCT nullif(sex, '')) AS c,
coalesce(list(DISTINCT year(exam_date) - 56) FILTER (suffix_age <> '' AND exam_date IS NOT NULL), []) AS ys,
coalesce(list(DISTINCT institution_key) FILTER (institution_key <> ''), []) AS ins FROM nh WHERE patient_id <> '' GROUP BY 1, 2),
pr AS (SELECT l.patient_id, bool_or(coalesce(CAST(l.nk = r.nk AS INT), 0) + coalesce(CAST(l.bd = r.bd AS INT), 0) + coalesce(CAST(l.sx = r.sx AS INT), 0)
 + CAST(list_has_any(l.ys, r.ys) AS INT) + CAST(list_has_any(l.ins, r.ins) AS INT) < 2) AS lone FROM s l JOIN s r ON l.patient_id = r.patient_id AND l.study_uid < r.study_uid GROUP BY 1),
g AS (SELECT patient_id, count(*) AS studies, concat_ws(',', CASE WHEN count(DISTINCT nk) > 1 THEN 'name_key' END, CASE WHEN count(DISTINCT bd) > 1 THEN 'birth_date' END,
CASE WHEN count(DISTINCT sx) > 1 THEN 'sex' END, CASE WHEN bool_or(a > 1 OR b > 1 OR c > 1) THEN 'within_study' END) AS conflicts,
bool_or(nk IS NULL OR (bd IS NULL AND sx IS NULL AND len(ys) = 0)) AS thin FROM s GROUP BY 1)
SELECT patient_id, studies, CASE WHEN conflicts <> '' THEN 'conflict' WHEN thin OR coalesce(lone, false) THEN 'insufficient' ELSE 'confirmed' END AS decision, conflicts FROM g LEFT JOIN pr USING (patient_id)"""


def e04_package_gate(spark, sf):
    nh = _nh(spark, sf).where("patient_id <> ''")
    p = I.set_profiles(nh.withColumn("person", F.concat_ws("|", "name_key", "patient_id")), "person")
    return I.package_gate(p.select(F.split_part("person", F.lit("|"), F.lit(1)).alias("subject"), F.col("person").alias("key"), "names", "birth_dates", "sexes"), "subject")


E04 = """WITH p AS (SELECT name_key AS subject, patient_id AS key, list(DISTINCT birth_date) FILTER (birth_date IS NOT NULL) AS b, list(DISTINCT sex) FILTER (sex <> '') AS s FROM nh WHERE patient_id <> '' GROUP BY 1, 2),
j AS (SELECT l.subject, bool_or(CASE WHEN len(l.b) > 0 AND len(r.b) > 0 AND NOT list_has_any(l.b, r.b) AND len(l.s) > 0 AND len(r.s) > 0 AND NOT list_has_any(l.s, r.s) THEN true ELSE false END) AS hard
FROM p l JOIN p r ON l.subject = r.subject AND l.key < r.key GROUP BY 1)
SELECT subject, count(*) AS profiles, CASE WHEN any_value(hard) THEN 'different_person_unresolved' ELSE 'confirmed' END AS decision FROM p LEFT JOIN j USING (subject) GROUP BY 1"""


def _groups(spark, sf):
    people = staged(I.profiles(_nh(spark, sf)), "identity-profiles")
    related = staged(I.pairs(people), "identity-pairs")
    return people, related, I.groups(people, related)


def e07_identity_groups(spark, sf):
    return _groups(spark, sf)[2]


def e10_identity_routes(spark, sf):
    people, related, grouped = _groups(spark, sf)
    return I.routes(I.group_keys(staged(grouped, "identity-groups")), related)


def e12_review_rows(spark, sf):
    return I.review_rows(I.pairs(I.profiles(_nh(spark, sf))))


E12 = f"""WITH {PAIRS} SELECT left_id, right_id, CASE relation WHEN 'review_group' THEN 'grouped_needs_review' WHEN 'possible' THEN 'needs_review' WHEN 'conflict' THEN 'conflict' ELSE 'auto_resolved' END AS status,
CASE WHEN conflicts <> '' THEN conflicts ELSE evidence END AS basis FROM prs"""


def e13_source_audit(spark, sf):
    nh = _nh(spark, sf)
    return I.source_audit(nh, _groups(spark, sf)[2])


def _subjects(spark, sf):
    r = registry(spark, sf)
    return r.groupBy(F.col("center_name").alias("center"), F.col("screening_number").alias("screening")).agg(F.min("source_order").alias("source_order"))


def e16_code_ledger(spark, sf):
    s = _subjects(spark, sf).withColumn("natural", text.natural_key(F.col("screening")))
    from pyspark.sql import Window as W

    known = s.where("source_order % 3 = 0").withColumn("number", F.row_number().over(W.partitionBy("center").orderBy("natural", "screening")).cast("long"))
    out = I.code_ledger(s.select("center", "screening", "natural"), known.select("center", "screening", "number"))
    return out.select("center", "screening", text.code_text(F.col("number")).alias("code"), "is_new")


E16 = """WITH s AS (SELECT center_name AS center, screening_number AS screening, min(source_order) AS so FROM registry GROUP BY 1, 2),
k AS (SELECT center, screening, row_number() OVER (PARTITION BY center ORDER BY screening) AS number FROM s WHERE so % 3 = 0),
d AS (SELECT s.center, s.screening, k.number, row_number() OVER (PARTITION BY s.center, k.number IS NULL ORDER BY s.screening) AS pos FROM s LEFT JOIN k USING (center, screening)),
l AS (SELECT center, max(number) AS last FROM k GROUP BY 1)
SELECT center, screening, CASE WHEN coalesce(number, coalesce(last, 0) + pos) < 1000 THEN lpad(CAST(coalesce(number, coalesce(last, 0) + pos) AS VARCHAR), 3, '0') ELSE CAST(coalesce(number, coalesce(last, 0) + pos) AS VARCHAR) END AS code, number IS NULL AS is_new FROM d LEFT JOIN l USING (center)"""

QUERIES = {
    "a06_identity_evidence": a06_identity_evidence, "a07_identity_profiles": a07_identity_profiles, "a08_dominant_patient": a08_dominant_patient, "a09_set_profiles": a09_set_profiles, "e01_identity_pairs": e01_identity_pairs,
    "e03_subject_gate": e03_subject_gate, "e04_package_gate": e04_package_gate, "e07_identity_groups": e07_identity_groups, "e10_identity_routes": e10_identity_routes,
    "e12_review_rows": e12_review_rows, "e13_source_audit": e13_source_audit, "e16_code_ledger": e16_code_ledger,
}
ORACLE_SQL = {
    "a06_identity_evidence": oracle(A06, "nh"), "a07_identity_profiles": oracle(A07, "nh"), "a08_dominant_patient": oracle(A08, "nh"), "a09_set_profiles": oracle(A09, "nh"), "e01_identity_pairs": oracle(E01, "nh"),
    "e03_subject_gate": oracle(E03, "nh"), "e04_package_gate": oracle(E04, "nh"), "e12_review_rows": oracle(E12, "nh"), "e16_code_ledger": oracle(E16, "registry"),
}
