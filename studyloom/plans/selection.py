"""Queries that select Studies by visit."""

from __future__ import annotations

from pyspark.sql import functions as F

from studyloom.operators import headers as H
from studyloom.operators import selection as S
from studyloom.plans.adapters import hdr, oracle, registry
from studyloom.sources import sinks
from studyloom.storage import new_path


def _tokens(spark, sf):
    """Periods of every acquisition since the patient's first visit, in months as text."""
    nh = H.normalised(hdr(spark, sf)).where("patient_id <> '' AND acquisition_date IS NOT NULL")
    first = nh.groupBy("patient_id").agg(F.min("acquisition_date").alias("first_date"))
    d = nh.join(first, "patient_id").where("modality = 'CT'")
    months = F.floor(F.datediff("acquisition_date", "first_date") / 30)
    period = F.when(months == 0, "术中").when(months % 5 == 0, F.concat(F.lit("术后"), months.cast("string"), F.lit("个月"))).otherwise(months.cast("string"))
    return d.select("patient_id", "study_uid", period.alias("period")).distinct()


TOKENS = """ft AS (SELECT patient_id, min(acquisition_date) AS fd FROM nh WHERE patient_id <> '' GROUP BY 1),
tk AS (SELECT DISTINCT patient_id, study_uid, CAST(floor(datediff('day', fd, acquisition_date) / 30) AS BIGINT) AS m FROM nh JOIN ft USING (patient_id) WHERE modality = 'CT' AND acquisition_date IS NOT NULL),
cl AS (SELECT patient_id, study_uid, CASE WHEN m = 0 OR m < 3 THEN 'PENDING' WHEN m < 9 THEN '6M' WHEN m <= 15 THEN '12M' ELSE '12M_CANDIDATE' END AS c, CASE WHEN m > 0 THEN CAST(m AS DOUBLE) END AS months FROM tk),
vg AS (SELECT patient_id, study_uid, count(DISTINCT c) AS kinds, min(c) AS c, max(months) - min(months) AS spread, first(months ORDER BY abs(months - 12), months) AS months FROM cl GROUP BY 1, 2),
vc AS (SELECT patient_id, study_uid, CASE WHEN kinds > 1 OR (c <> '6M' AND coalesce(spread, 0) > 0.05) THEN 'PENDING' ELSE c END AS visit, months AS m0 FROM vg),
vv AS (SELECT patient_id, study_uid, visit, CASE WHEN visit <> 'PENDING' THEN m0 END AS months FROM vc)"""


def _visits(spark, sf):
    return S.classify(_tokens(spark, sf), ["patient_id", "study_uid"])


def a12_visit_class(spark, sf):
    return _visits(spark, sf)


A12 = f"WITH {TOKENS} SELECT * FROM vv"


def f06_period_rules(spark, sf):
    h = hdr(spark, sf)
    period = F.when(F.col("modality_raw") == "CT", " 术前").when(F.col("modality_raw") == "XA", "术中").otherwise("术后")
    sop = F.when(F.col("payload") == "pix0", " n/a").otherwise(F.col("sop_uid"))
    rules = S.period_rules(h.select("relative_path", period.alias("period"), "series_uid", sop.alias("sop_uid")))
    return rules.select("relative_path", "period", "selector_field", "selector_uid")


F06 = """SELECT relative_path, CASE modality_raw WHEN 'CT' THEN '术前' ELSE '术中' END AS period,
CASE modality_raw WHEN 'CT' THEN 'SeriesInstanceUID' ELSE 'SOPInstanceUID' END AS selector_field,
CASE WHEN modality_raw = 'CT' THEN series_uid WHEN payload = 'pix0' THEN '' ELSE sop_uid END AS selector_uid FROM hdr WHERE modality_raw IN ('CT', 'XA')"""


def w02_nearest_visit(spark, sf):
    return S.nearest_visit(_visits(spark, sf), ["patient_id"])


W02C = (
    TOKENS
    + """,
vf AS (SELECT *, CASE WHEN visit IN ('12M', '12M_CANDIDATE') THEN abs(months - 12) END AS far FROM vv),
vl AS (SELECT *, min(far) OVER (PARTITION BY patient_id) AS least FROM vf),
vt AS (SELECT *, count(*) FILTER (far = least) OVER (PARTITION BY patient_id) AS ties FROM vl),
vs AS (SELECT patient_id, study_uid, visit, months, CASE WHEN visit = '6M' THEN 'matched' WHEN far IS NULL THEN 'pending' WHEN far = least AND ties = 1 THEN 'selected' WHEN far = least THEN 'tied' ELSE 'not_selected' END AS status FROM vt)"""
)
W02 = f"WITH {W02C} SELECT * FROM vs"


def k09_selection_tables(spark, sf):
    """The report of a selection, read back by table and visit."""
    d = S.nearest_visit(_visits(spark, sf), ["patient_id"])
    done = F.col("status").isin("selected", "matched")
    tables = {"main": d.where(done), "detail": d, "exceptions": d.where(F.col("status").isin("tied", "pending"))}
    root = new_path(spark, "selection-report")
    sinks.write_tables(tables, root, {"detail": "visit"})
    read = [t.select(F.lit(name).alias("report"), "visit", "status") for name, t in sinks.read_tables(spark, root, list(tables)).items()]
    return read[0].union(read[1]).union(read[2]).groupBy("report", "visit", "status").agg(F.count(F.lit(1)).alias("studies"))


K09 = f"""WITH {W02C}, u AS (SELECT 'main' AS report, visit, status FROM vs WHERE status IN ('selected', 'matched') UNION ALL SELECT 'detail', visit, status FROM vs
UNION ALL SELECT 'exceptions', visit, status FROM vs WHERE status IN ('tied', 'pending')) SELECT report, visit, status, count(*) AS studies FROM u GROUP BY ALL"""


def k08_sheet_names(spark, sf):
    """Names of centers with their subjects' digits, as long and as alike as sheets can't have them."""
    r = registry(spark, sf)
    k = F.col("source_order") % 40
    mark = F.when(k % 2 == 0, F.concat(F.lit("[a] "), k.cast("string"))).otherwise(F.concat(F.lit("?A: "), k.cast("string")))
    return sinks.sheet_names(r.select(F.concat("center_name", F.lit(" of the northern district "), mark).alias("name")))


K08 = """WITH n AS (SELECT DISTINCT center_name || ' of the northern district ' || CASE WHEN source_order % 2 = 0 THEN '[a] ' ELSE '?A: ' END || CAST(source_order % 40 AS VARCHAR) AS name FROM registry),
b AS (SELECT name, substr(trim(regexp_replace(name, '[][\\/*?:]', '_', 'g'), ' '''), 1, 31) AS base FROM n),
o AS (SELECT *, row_number() OVER (PARTITION BY lower(base) ORDER BY name) AS k FROM b)
SELECT name, CASE WHEN k = 1 THEN base ELSE substr(base, 1, 30 - length(CAST(k AS VARCHAR))) || '_' || k END AS sheet FROM o"""


def w03_selected_veto(spark, sf):
    """Several ids of one number group are one person here; two selected visits of a group veto each other."""
    d = S.nearest_visit(_visits(spark, sf), ["patient_id"]).withColumn("person", F.substring("patient_id", 1, 6))
    return S.veto_several(d, ["person"]).select("person", "patient_id", "study_uid", "status", "vetoed")


W03 = f"""WITH {W02C} SELECT substr(patient_id, 1, 6) AS person, patient_id, study_uid, status,
status = 'selected' AND count(*) FILTER (status = 'selected') OVER (PARTITION BY substr(patient_id, 1, 6)) > 1 AS vetoed FROM vs"""


def w04_differing_plans(spark, sf):
    h = hdr(spark, sf)
    return S.veto_differing(h.select("study_uid", "modality_raw", "slice_thickness_raw").distinct(), "study_uid", ["modality_raw", "slice_thickness_raw"])


W04 = """WITH p AS (SELECT DISTINCT study_uid, modality_raw, slice_thickness_raw FROM hdr)
SELECT *, count(*) OVER (PARTITION BY study_uid) > 1 AS vetoed FROM p"""


def w06_first_keeps(spark, sf):
    return S.first_keeps(hdr(spark, sf).where("sop_uid <> ''").select("relative_path", "sop_uid", "payload").distinct(), ["sop_uid"], ["relative_path", "payload"])


W06 = """WITH d AS (SELECT DISTINCT relative_path, sop_uid, payload FROM hdr WHERE sop_uid <> '')
SELECT *, CASE WHEN row_number() OVER (PARTITION BY sop_uid ORDER BY relative_path, payload) = 1 THEN 'kept' ELSE 'duplicate' END AS status FROM d"""


def v04_plan_faults(spark, sf):
    r = registry(spark, sf)
    k = F.col("source_order")
    code = F.when(k % 13 == 0, k.cast("string")).otherwise(F.lpad((k % 900).cast("string"), 3, "0"))
    period = F.when(k % 3 == 0, "6M").when(k % 3 == 1, "12M").otherwise("18M")
    plans = r.select(k.alias("row"), code.alias("code"), period.alias("period"), F.concat(code, F.when(k % 11 == 0, "_").otherwise("-"), period).alias("folder"))
    return S.plan_faults(plans)


V04 = """WITH p AS (SELECT source_order AS row, CASE WHEN source_order % 13 = 0 THEN CAST(source_order AS VARCHAR) ELSE lpad(CAST(source_order % 900 AS VARCHAR), 3, '0') END AS code,
CASE source_order % 3 WHEN 0 THEN '6M' WHEN 1 THEN '12M' ELSE '18M' END AS period, CASE WHEN source_order % 11 = 0 THEN '_' ELSE '-' END AS sep FROM registry)
SELECT row, code, period, code || sep || period AS folder, concat_ws(',', CASE WHEN NOT regexp_full_match(code, '[0-9]{3,}') THEN 'code' END, CASE WHEN period = '18M' THEN 'period' END, CASE WHEN sep = '_' THEN 'folder' END) AS faults FROM p"""

QUERIES = {
    "a12_visit_class": a12_visit_class, "w02_nearest_visit": w02_nearest_visit, "w03_selected_veto": w03_selected_veto, "w04_differing_plans": w04_differing_plans,
    "w06_first_keeps": w06_first_keeps, "f06_period_rules": f06_period_rules, "k08_sheet_names": k08_sheet_names, "k09_selection_tables": k09_selection_tables, "v04_plan_faults": v04_plan_faults,
}
ORACLE_SQL = {
    "a12_visit_class": oracle(A12, "nh"), "w02_nearest_visit": oracle(W02, "nh"), "w03_selected_veto": oracle(W03, "nh"), "w04_differing_plans": oracle(W04, "hdr"),
    "w06_first_keeps": oracle(W06, "hdr"), "f06_period_rules": oracle(F06, "hdr"), "k08_sheet_names": oracle(K08, "registry"), "k09_selection_tables": oracle(K09, "nh"), "v04_plan_faults": oracle(V04, "registry"),
}
