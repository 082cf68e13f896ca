"""Queries over identity across subjects and over time."""

from __future__ import annotations

from pyspark.sql import functions as F

from studyloom.operators import headers as H
from studyloom.operators import identity as I
from studyloom.operators import routing as R
from studyloom.plans.adapters import hdr, oracle, registry, table
from studyloom.plans.identity import PROFILES
from studyloom.storage import staged


def _profiles(spark, sf, keep="true"):
    nh = H.normalised(hdr(spark, sf)).where("patient_id <> ''").where(keep)
    p = I.set_profiles(nh, "patient_id")
    return p.select(F.substring("patient_id", 1, 6).alias("subject"), F.col("patient_id").alias("key"), F.array("patient_id").alias("ids"), "names", "birth_dates", "sexes", "birth_years", "files")


# whether two profiles l and r agree and disagree in birth dates, sexes and birth years
_YEARS = "len(list_filter(l.y, lambda a: len(list_filter(r.y, lambda b: abs(a - b) <= 1)) > 0)) > 0"
_AGREE = f"(CAST(list_has_any(l.b, r.b) AS INT) + CAST(list_has_any(l.s, r.s) AS INT) + CAST({_YEARS} AS INT))"
_BOTH = lambda c: f"len(l.{c}) > 0 AND len(r.{c}) > 0"
_DIFFER = f"(CAST({_BOTH('b')} AND NOT list_has_any(l.b, r.b) AS INT) + CAST({_BOTH('s')} AND NOT list_has_any(l.s, r.s) AS INT) + CAST({_BOTH('y')} AND NOT {_YEARS} AS INT))"
_SAME = "list_has_any(l.names, r.names)"
SETS = f"""sp AS (SELECT substr(patient_id, 1, 6) AS subject, patient_id AS key, list_sort(list(DISTINCT name_key)) AS names, coalesce(list(DISTINCT CAST(birth_date AS VARCHAR)) FILTER (birth_date IS NOT NULL), []) AS b,
 coalesce(list(DISTINCT sex) FILTER (sex <> ''), []) AS s, coalesce(list(DISTINCT by_age) FILTER (by_age IS NOT NULL), []) AS y, count(*) AS files
 FROM (SELECT *, year(exam_date) - CAST(substr(CASE WHEN age <> '' THEN age ELSE nullif(suffix_age, '') END, 1, 3) AS INT) AS by_age FROM (SELECT * REPLACE (nullif(age, '') AS age) FROM nh)) WHERE patient_id <> '' GROUP BY 1, 2),
sn AS (SELECT *, unnest(names) AS name FROM sp),
sm AS (SELECT DISTINCT l.subject, l.key, r.subject AS to_subject, 'name' || CASE WHEN list_has_any(l.b, r.b) THEN '+birth_date' ELSE '' END || CASE WHEN list_has_any(l.s, r.s) THEN '+sex' ELSE '' END || CASE WHEN {_YEARS} THEN '+birth_year' ELSE '' END AS evidence
 FROM sn l JOIN sn r ON l.name = r.name AND l.subject <> r.subject WHERE {_DIFFER} = 0 AND {_AGREE} >= 2),
pe AS (SELECT l.subject, l.key, r.key AS peer, NOT {_SAME} AS mismatch, CASE WHEN {_SAME} THEN {_DIFFER} >= 2 ELSE {_DIFFER} >= 1 END AS hard, NOT {_SAME} OR {_AGREE} < 2 AS thin FROM sp l JOIN sp r ON l.subject = r.subject AND l.key <> r.key),
pn AS (SELECT subject, key, bool_or(hard) AS hard, bool_or(mismatch) AS mismatch, bool_or(thin AND NOT hard) AS weak FROM pe GROUP BY 1, 2),
iw AS (SELECT subject, key, len(names) <> 1 OR i = 1 AS thin, i >= 2 AS inner_ FROM (SELECT *, CAST(len(b) > 1 AS INT) + CAST(len(s) > 1 AS INT) + CAST(coalesce(list_max(y) - list_min(y) > 1, false) AS INT) AS i FROM sp)),
r0 AS (SELECT iw.*, coalesce(hard, false) AS hard, coalesce(mismatch, false) AS mismatch, coalesce(weak, false) AS weak, n, to_subject, coalesce(n = 1, false) AND coalesce(hard OR mismatch, false) AS leaves FROM iw LEFT JOIN pn USING (subject, key)
 LEFT JOIN (SELECT subject, key, count(DISTINCT to_subject) AS n, min(to_subject) AS to_subject FROM sm GROUP BY 1, 2) USING (subject, key)),
r1 AS (SELECT *, bool_and(leaves) OVER w AS none_left, bool_or(hard OR inner_) OVER w AS conflict, bool_or(thin OR weak) OVER w AS doubt FROM r0 WINDOW w AS (PARTITION BY subject)),
r2 AS (SELECT * REPLACE (leaves AND NOT none_left AS leaves) FROM r1),
fa AS (SELECT DISTINCT pe.subject, pe.key FROM pe JOIN r2 ON r2.subject = pe.subject AND r2.key = pe.peer WHERE pe.hard AND NOT r2.leaves),
r3 AS (SELECT r2.*, NOT leaves AND (inner_ OR fa.key IS NOT NULL) AS held FROM r2 LEFT JOIN fa ON fa.subject = r2.subject AND fa.key = r2.key)"""


def e05_strong_matches(spark, sf):
    return R.strong_matches(_profiles(spark, sf))


def e06_reroutes(spark, sf):
    return R.reroutes(staged(_profiles(spark, sf), "reroute-profiles"))  # read six times


E05 = f"WITH {SETS} SELECT * FROM sm"
E06 = f"""WITH {SETS} SELECT subject, key, CASE WHEN leaves THEN to_subject WHEN NOT held THEN subject END AS target,
CASE WHEN leaves THEN 'rerouted' WHEN held THEN 'different_person_unresolved' WHEN (NOT conflict AND doubt) OR (n IS NOT NULL AND NOT hard) THEN 'screening_default_warning' ELSE 'confirmed_same' END AS action FROM r3"""


def e11_history_drift(spark, sf):
    p = I.profiles(H.normalised(hdr(spark, sf))).select("patient_id", "name_key", "birth_date", "sex", "birth_year", "files")
    k = F.col("files")
    old = p.where(k % 5 != 0).select(
        "patient_id", F.when(k % 7 == 0, F.concat("name_key", F.lit("x"))).otherwise(F.col("name_key")).alias("name_key"), F.when(k % 3 == 0, F.date_add("birth_date", 1)).otherwise(F.col("birth_date")).alias("birth_date"),
        F.when(k % 2 == 0, "").otherwise(F.col("sex")).alias("sex"), (F.col("birth_year") + k % 4).alias("birth_year"),
    )
    out = R.merge_history(old, p.drop("files"))
    return out.withColumn("birth_date", F.col("birth_date").cast("string"))


E11 = f"""WITH {PROFILES}, o AS (SELECT patient_id, CASE WHEN files % 7 = 0 THEN name_key || 'x' ELSE name_key END AS name_key, CASE WHEN files % 3 = 0 THEN birth_date + 1 ELSE birth_date END AS birth_date,
CASE WHEN files % 2 = 0 THEN '' ELSE sex END AS sex, birth_year + files % 4 AS birth_year FROM prof WHERE files % 5 <> 0)
SELECT p.patient_id, coalesce(nullif(o.name_key, ''), p.name_key) AS name_key, CAST(coalesce(o.birth_date, p.birth_date) AS VARCHAR) AS birth_date, coalesce(nullif(o.sex, ''), p.sex) AS sex, coalesce(o.birth_year, p.birth_year) AS birth_year,
concat_ws(',', CASE WHEN o.birth_date <> p.birth_date THEN 'birth_date' END, CASE WHEN nullif(o.sex, '') <> nullif(p.sex, '') THEN 'sex' END, CASE WHEN abs(o.birth_year - p.birth_year) > 1.25 THEN 'age' END,
CASE WHEN nullif(o.name_key, '') <> nullif(p.name_key, '') THEN 'name' END) AS drift FROM prof p LEFT JOIN o USING (patient_id)"""


def _folders(spark, sf):
    """A folder holds five customers' files; a profile is what a folder's files of one name and id say, of which the name may lack."""
    nh = H.normalised(hdr(spark, sf)).where("patient_id <> ''")
    name = F.when(F.col("file_size") % 3 == 0, "").otherwise(F.col("name_key"))
    folder = F.concat(F.lit("F"), F.floor(F.substring("patient_id", 2, 6).cast("int") / 5).cast("string"))
    p = I.set_profiles(nh.withColumn("person", F.concat_ws("|", folder, name, "patient_id")), "person")
    at = lambda k: F.split_part("person", F.lit("|"), F.lit(k))
    one = lambda c: F.when(F.size(c) == 1, F.col(c)[0])
    return p.select(at(1).alias("folder"), at(3).alias("patient_id"), at(2).alias("name_key"), one("birth_dates").alias("birth_date"), one("sexes").alias("sex"), F.lit(None).cast("double").alias("birth_year"))


def e14_assigned_codes(spark, sf):
    p = staged(_folders(spark, sf), "folders")
    earlier = p.where(F.pmod(F.xxhash64("folder"), F.lit(4)) == 0).withColumn("code", F.concat(F.lit("E9"), F.lpad(F.pmod(F.xxhash64("patient_id"), F.lit(100)).cast("string"), 5, "0")))
    return R.assign_codes(p, earlier)


def e15_anonymous_ids(spark, sf):
    nh = H.normalised(hdr(spark, sf))
    order = F.split_part("relative_path", F.lit("/"), F.lit(2)).cast("long")
    subject = F.when(order % 3 == 0, "").otherwise(F.concat(F.lit(" folder "), (order % 50).cast("string")))
    key = lambda s: R.subject_key(s, F.col("patient_id"), F.lit(""), F.col("patient_name"), F.col("birth_date_raw"), F.col("source_subject"))
    return R.anonymous_ids(nh.select(F.col("relative_path").alias("path"), key(subject).alias("key"), key(F.lit("")).alias("legacy")))


E15 = """WITH RECURSIVE f0 AS (SELECT relative_path AS path, CAST(split_part(relative_path, '/', 2) AS BIGINT) AS o,
 CASE WHEN patient_id <> '' THEN 'PID||' || upper(patient_id) ELSE 'DEMOGRAPHIC|' || upper(patient_name) || '|' || birth_date_raw END AS legacy FROM nh),
fk AS (SELECT DISTINCT path, legacy, CASE WHEN o % 3 = 0 THEN legacy ELSE 'SOURCE_SUBJECT|FOLDER ' || (o % 50) END AS key FROM f0),
fl AS (SELECT *, lag(key) OVER (PARTITION BY legacy ORDER BY path, key) AS parent, row_number() OVER (PARTITION BY key ORDER BY path, legacy) AS nth FROM fk),
ff AS (SELECT key, path, parent FROM fl WHERE nth = 1),
rt AS (SELECT key, row_number() OVER (ORDER BY path, key) AS n FROM ff WHERE parent IS NULL),
tr AS (SELECT key, n FROM rt UNION ALL SELECT ff.key, tr.n FROM tr JOIN ff ON ff.parent = tr.key)
SELECT key, 'ANON' || lpad(CAST(n AS VARCHAR), 6, '0') AS anonymous_id FROM tr"""


def a20_ids_per_name(spark, sf):
    p = I.profiles(H.normalised(hdr(spark, sf)))
    return R.ids_per_code(p.select(F.col("name_key").alias("code"), "patient_id"))


A20 = f"WITH {PROFILES} SELECT name_key AS code, string_agg(patient_id, '|' ORDER BY patient_id) AS patient_ids FROM prof GROUP BY 1"


def a19_merged_profiles(spark, sf):
    p = R.merge_profiles(_profiles(spark, sf, "file_size % 2 = 0"), _profiles(spark, sf, "file_size % 2 = 1"))
    return p.select("subject", "key", "files", *[F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in ("ids", "names", "birth_dates", "sexes", "birth_years")])


A19 = f"WITH {SETS} SELECT subject, key, files, key AS ids, array_to_string(names, ',') AS names, coalesce(array_to_string(list_sort(b), ','), '') AS birth_dates, coalesce(array_to_string(list_sort(s), ','), '') AS sexes, array_to_string(list_sort(y), ',') AS birth_years FROM sp"


def j07_ledger_conflicts(spark, sf):
    r = registry(spark, sf).select(F.col("source_order").cast("string").alias("key"), "patient_name", "hospital_number", "screening_number")
    k = F.col("source_order")
    old = registry(spark, sf).where(k % 2 == 0).select(k.cast("string").alias("key"), F.when(k % 50 == 0, "OTHER").otherwise(F.col("patient_name")).alias("patient_name"), F.when(k % 4 == 0, "").otherwise(F.col("hospital_number")).alias("hospital_number"), F.when(k % 70 == 0, "9-H9").otherwise(F.col("screening_number")).alias("screening_number"))
    return R.ledger_conflicts(old, r, "key", ["patient_name", "hospital_number", "screening_number"])


J07 = """SELECT CAST(source_order AS VARCHAR) AS key, 'patient_name' AS attribute FROM registry WHERE source_order % 50 = 0 UNION ALL SELECT CAST(source_order AS VARCHAR), 'screening_number' FROM registry WHERE source_order % 70 = 0"""


def o03_audit_order(spark, sf):
    p = table(spark, sf, "part").select(F.when(F.col("p_partkey") % 6 == 0, F.concat(F.lit("X"), F.col("p_partkey").cast("string"))).otherwise(F.col("p_partkey").cast("string")).alias("code"))
    return R.audit_place(p)


O03 = "SELECT code, coalesce(try_cast(code AS BIGINT), 1000000000000) AS code_order FROM (SELECT CASE WHEN p_partkey % 6 = 0 THEN 'X' || p_partkey ELSE CAST(p_partkey AS VARCHAR) END AS code FROM part)"


def _renames(spark, sf):
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    f = o.select(k.cast("string").alias("folder"), (k % 500).cast("string").alias("code"), F.when(k % 13 == 0, None).otherwise(F.date_format("o_orderdate", "yyyyMMdd")).alias("date"), F.when(k % 29 == 0, "").otherwise(F.concat(F.lit("S"), (k % 37).cast("string"))).alias("subject"))
    over = o.where(k % 26 == 0).select(k.cast("string").alias("folder"), F.lit("20200101").alias("date"), F.lit(None).cast("string").alias("subject"))
    return R.rename_plan(f, over)


def t06_rename_faults(spark, sf):
    return _renames(spark, sf)[1]


T06 = """WITH d AS (SELECT CAST(o_orderkey AS VARCHAR) AS folder, CAST(o_orderkey % 500 AS VARCHAR) AS code, CASE WHEN o_orderkey % 26 = 0 THEN '20200101' WHEN o_orderkey % 13 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y%m%d') END AS date,
CASE WHEN o_orderkey % 29 = 0 THEN '' ELSE 'S' || o_orderkey % 37 END AS subject FROM orders),
n AS (SELECT *, count(*) OVER (PARTITION BY subject || '_' || coalesce(date, '') || '_' || code) AS same FROM d)
SELECT folder, 'date' AS reason FROM n WHERE date IS NULL UNION ALL SELECT folder, 'subject' FROM n WHERE subject = '' UNION ALL SELECT folder, 'target_taken' FROM n WHERE same > 1"""


def j11_routed_files(spark, sf):
    nh = H.normalised(hdr(spark, sf))
    routes = nh.where("patient_id <> ''").select("patient_id", F.concat_ws("_", "patient_id", F.lit("x")).alias("folder")).distinct()
    return R.route_files(nh.select("relative_path", "patient_id"), routes)


J11 = "SELECT relative_path, patient_id, CASE WHEN patient_id = '' THEN '_identity_review' ELSE patient_id || '_x' END AS folder FROM nh"

QUERIES = {
    "e05_strong_matches": e05_strong_matches, "e06_reroutes": e06_reroutes, "e11_history_drift": e11_history_drift, "e14_assigned_codes": e14_assigned_codes, "e15_anonymous_ids": e15_anonymous_ids, "a20_ids_per_name": a20_ids_per_name,
    "a19_merged_profiles": a19_merged_profiles, "j07_ledger_conflicts": j07_ledger_conflicts, "o03_audit_order": o03_audit_order, "t06_rename_faults": t06_rename_faults, "j11_routed_files": j11_routed_files,
}
ORACLE_SQL = {
    "e05_strong_matches": oracle(E05, "nh"), "e06_reroutes": oracle(E06, "nh"), "e11_history_drift": oracle(E11, "nh"), "e15_anonymous_ids": oracle(E15, "nh"), "a20_ids_per_name": oracle(A20, "nh"), "a19_merged_profiles": oracle(A19, "nh"),
    "j07_ledger_conflicts": oracle(J07, "registry"), "o03_audit_order": O03, "t06_rename_faults": T06, "j11_routed_files": oracle(J11, "nh"),
}
