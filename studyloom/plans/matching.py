"""Queries that match headers to registries."""

from __future__ import annotations

from pyspark.sql import functions as F

from studyloom.functions import dates, domain, text
from studyloom.operators import files as P
from studyloom.operators import headers as H
from studyloom.operators import matching as M
from studyloom.plans.adapters import hdr, oracle, registry, table
from studyloom.sources import containers as C
from studyloom.storage import staged


def _screened(spark, sf):
    nh = H.normalised(hdr(spark, sf))
    number = F.when(F.col("patient_id") == "", "").otherwise(F.concat(F.lit("00-H"), F.right("patient_id", F.lit(3))))
    return nh.withColumn("screening", number)


def _registry(spark, sf):
    return M.registry_rows(registry(spark, sf))


REG = """rk AS (SELECT *, lower(regexp_replace(patient_name, '[ ^]+', '', 'g')) AS name_key FROM registry),
bn AS (SELECT name_key, count(DISTINCT (hospital_number, surgery_date)) AS n, min(source_order) AS so FROM rk WHERE name_key <> '' GROUP BY 1),
bs AS (SELECT screening_number, count(DISTINCT (hospital_number, surgery_date)) AS n, min(source_order) AS so FROM rk GROUP BY 1)"""
REPORT = (
    REG
    + """,
d AS (SELECT *, CASE WHEN coalesce(frames, 1) > 1 THEN sop_uid ELSE '' END AS instance, CASE WHEN patient_id = '' THEN '' ELSE '00-H' || right(patient_id, 3) END AS screening FROM nh WHERE sop_uid <> ''),
nm AS (SELECT study_uid, series_uid, instance, first(patient_name ORDER BY n DESC, patient_name) AS patient_name FROM (SELECT study_uid, series_uid, instance, patient_name, count(*) AS n FROM d GROUP BY ALL) GROUP BY 1, 2, 3),
g AS (SELECT study_uid, series_uid, instance, coalesce(min(acquisition_date), min(study_date)) AS imaging_date,
 CASE WHEN min(acquisition_date) IS NOT NULL THEN count(DISTINCT acquisition_date) ELSE count(DISTINCT study_date) END AS dates,
 CASE WHEN count(DISTINCT modality) = 1 THEN min(modality) ELSE 'NA' END AS modality, CASE WHEN count(DISTINCT series_description) = 1 THEN min(series_description) ELSE 'NA' END AS series_description,
 count(DISTINCT sop_uid) AS instances, count(*) AS files, max(frames) AS frames, coalesce(min(nullif(screening, '')), '') AS screening, count(DISTINCT nullif(screening, '')) AS screenings,
 count(DISTINCT nullif(patient_id, '')) AS ids, count(DISTINCT nullif(lower(regexp_replace(patient_name, '[ ^]+', '', 'g')), '')) AS names FROM d GROUP BY 1, 2, 3),
j AS (SELECT g.*, nm.patient_name, bn.n AS nn, bn.so AS nso, bs.n AS sn, bs.so AS sso FROM g JOIN nm USING (study_uid, series_uid, instance)
 LEFT JOIN bn ON bn.name_key = lower(regexp_replace(nm.patient_name, '[ ^]+', '', 'g')) LEFT JOIN bs ON bs.screening_number = g.screening),
k AS (SELECT *, CASE WHEN nn = 1 THEN 'name' WHEN nn > 1 THEN 'ambiguous_name' WHEN sn = 1 THEN 'screening_number' WHEN sn > 1 THEN 'ambiguous_screening_number' ELSE 'missing' END AS match,
 CASE WHEN nn = 1 THEN nso WHEN nn IS NULL AND sn = 1 THEN sso END AS source_order FROM j),
rep AS (SELECT k.*, r.hospital_number, r.surgery_date FROM k LEFT JOIN registry r ON r.source_order = k.source_order)"""
)


def a10_center_report(spark, sf):
    r = M.series_report(_screened(spark, sf), _registry(spark, sf)[0])
    return r.select(
        "study_uid", "series_uid", "instance", F.col("imaging_date").cast("string").alias("imaging_date"), "dates", "modality", "series_description", "instances", "frames",
        "patient_name", "match", "hospital_number", F.col("surgery_date").cast("string").alias("surgery_date"), "period",
    )


A10 = f"""WITH {REPORT} SELECT study_uid, series_uid, instance, CAST(imaging_date AS VARCHAR) AS imaging_date, dates, modality, series_description, instances, frames, patient_name, match, hospital_number,
CAST(surgery_date AS VARCHAR) AS surgery_date, CASE WHEN surgery_date IS NULL OR imaging_date IS NULL THEN 'NA' WHEN imaging_date < surgery_date THEN '术前' WHEN imaging_date = surgery_date THEN '术中'
ELSE printf('%.2f', round(datediff('day', surgery_date, imaging_date) / 30.0, 2)) END AS period FROM rep"""


def a10_report_exceptions(spark, sf):
    return M.report_exceptions(M.series_report(_screened(spark, sf), _registry(spark, sf)[0]))


A10X = f"""WITH {REPORT} SELECT study_uid, series_uid, instance, match AS reason FROM rep WHERE match IN ('missing', 'ambiguous_name', 'ambiguous_screening_number')
UNION ALL SELECT study_uid, series_uid, instance, 'missing_imaging_date' FROM rep WHERE imaging_date IS NULL
UNION ALL SELECT study_uid, series_uid, instance, 'several_imaging_dates' FROM rep WHERE dates > 1
UNION ALL SELECT study_uid, series_uid, instance, 'missing_surgery_date' FROM rep WHERE match IN ('name', 'screening_number') AND surgery_date IS NULL
UNION ALL SELECT study_uid, series_uid, instance, 'several_names' FROM rep WHERE names > 1 UNION ALL SELECT study_uid, series_uid, instance, 'several_screening_numbers' FROM rep WHERE screenings > 1
UNION ALL SELECT study_uid, series_uid, instance, 'several_patient_ids' FROM rep WHERE ids > 1 UNION ALL SELECT study_uid, series_uid, instance, 'repeated_instances' FROM rep WHERE files > instances"""


BLOCK = ("中心名称", "姓名", "住院号", "手术日期")


def _sheets(spark, sf):
    """A sheet for each center: the subjects twice side by side, in some centers with a difference or a row less in the second block, and
    the center's name in the first row only."""
    from pyspark.sql import Window as W

    r = registry(spark, sf).withColumn("nth", F.row_number().over(W.partitionBy("center_name").orderBy("source_order")))
    k = F.split_part("center_name", F.lit(" "), F.lit(2)).cast("int")
    once = [F.when(F.col("nth") == 1, F.col("center_name")).otherwise(""), F.col("patient_name"), F.col("hospital_number"), F.coalesce(F.col("surgery_date").cast("string"), F.lit(""))]
    other = F.when((k % 7 == 3) & (F.col("nth") == 2), F.concat("hospital_number", F.lit("x"))).otherwise(F.col("hospital_number"))
    gone = (k % 7 == 5) & (F.col("nth") == 3)
    second = [F.when(gone, "").otherwise(c) for c in (once[0], once[1], other, once[3])]
    body = r.select("center_name", (F.col("nth") + 1).alias("row"), F.array(F.col("source_order").cast("string"), *once, F.lit(""), *second).alias("cells"))
    head = r.select("center_name").distinct().select("center_name", F.lit(1).alias("row"), F.array(*[F.lit(c) for c in ("#", *BLOCK, "", *BLOCK)]).alias("cells"))
    return head.unionByName(body).select(F.lit("w").alias("workbook"), F.col("center_name").alias("sheet"), "row", "cells")


def s15_repeated_blocks(spark, sf):
    long = C.repeated_blocks(_sheets(spark, sf), list(BLOCK))
    long = M.fill_down(long, BLOCK[0], ["workbook", "sheet", "block"], "__row__")
    bad = C.differing_blocks(long, [*BLOCK]).select("sheet").distinct().withColumn("differs", F.lit(True))
    d = long.where("block = 1").join(bad, "sheet", "left")
    return d.select("sheet", F.col("__order__").alias("source_order"), F.col(BLOCK[0]).alias("center_name"), F.col(BLOCK[1]).alias("patient_name"), F.col(BLOCK[2]).alias("hospital_number"), F.coalesce("differs", F.lit(False)).alias("differs"))


S15B = """WITH r AS (SELECT *, CAST(split_part(center_name, ' ', 2) AS INT) AS k, count(*) OVER (PARTITION BY center_name) AS n, row_number() OVER (PARTITION BY center_name ORDER BY source_order) AS nth FROM registry)
SELECT center_name AS sheet, CAST(source_order AS INT) AS source_order, center_name, patient_name, hospital_number, coalesce((k % 7 = 3 AND n >= 2) OR (k % 7 = 5 AND n >= 3), false) AS differs FROM r"""


def s15_registry_exceptions(spark, sf):
    return _registry(spark, sf)[1]


S15 = """WITH o AS (SELECT min(source_order) AS source_order, hospital_number, surgery_date FROM registry GROUP BY center_name, patient_name, hospital_number, surgery_date, screening_number)
SELECT source_order, 'missing_hospital_number' AS reason FROM o WHERE hospital_number = '' UNION ALL SELECT source_order, 'missing_surgery_date' FROM o WHERE surgery_date IS NULL"""


def w01_fill_down(spark, sf):
    r = registry(spark, sf)
    head = r.withColumn("cell", F.when(F.col("source_order") % 10 == 0, F.col("center_name")).otherwise("")).withColumn("sheet", (F.col("source_order") / 500).cast("int"))
    return M.fill_down(head, "cell", ["sheet"], "source_order").select("source_order", "sheet", F.col("cell").alias("center"))


W01 = """SELECT source_order, CAST(floor(source_order / 500) AS INTEGER) AS sheet, last_value(CASE WHEN source_order % 10 = 0 THEN center_name END IGNORE NULLS) OVER (PARTITION BY floor(source_order / 500) ORDER BY source_order ROWS UNBOUNDED PRECEDING) AS center FROM registry"""


def j03_center_resolution(spark, sf):
    n = table(spark, sf, "nation")
    r = _registry(spark, sf)[0]
    centers = r.groupBy("center_key").agg(F.array_sort(F.collect_set("name_key")).alias("names"))
    names = r.groupBy("center_key").agg(F.slice(F.array_sort(F.collect_set("name_key")), 1, 3).alias("names"))
    f = n.select("n_nationkey", F.concat(F.lit("center"), F.col("n_nationkey").cast("string")).alias("center_key")).join(names, "center_key", "left")
    form = F.when(F.col("n_nationkey") % 3 == 0, F.concat(F.lit("Center_"), F.col("n_nationkey").cast("string"))).when(F.col("n_nationkey") % 3 == 1, F.concat(F.lit("Site-"), F.col("n_nationkey").cast("string"))).otherwise(
        F.concat(F.lit("Imaging (CENTER "), F.col("n_nationkey").cast("string"), F.lit(")"))
    )
    folders = f.select(form.alias("folder"), F.coalesce("names", F.array().cast("array<string>")).alias("names"))
    k = F.col("n_nationkey")
    named = F.when(k % 10 == 9, "NOWHERE").otherwise(F.concat(F.lit("center-"), ((k + 1) % 25).cast("string")))
    return M.resolve_centers(folders, centers, f.where(k % 5 == 4).select(form.alias("folder"), named.alias("center")))


J03 = """WITH r AS (SELECT lower(replace(center_name, ' ', '')) AS ck, lower(replace(patient_name, ' ', '')) AS nk FROM registry),
c AS (SELECT ck, list_sort(list(DISTINCT nk)) AS names FROM r GROUP BY 1),
f AS (SELECT CASE n_nationkey % 3 WHEN 0 THEN 'Center_' || n_nationkey WHEN 1 THEN 'Site-' || n_nationkey ELSE 'Imaging (CENTER ' || n_nationkey || ')' END AS folder,
 CASE n_nationkey % 3 WHEN 0 THEN 'center' || n_nationkey WHEN 1 THEN 'site' || n_nationkey ELSE 'imagingcenter' || n_nationkey END AS fk, c.names[1:3] AS names,
 CASE WHEN n_nationkey % 10 = 9 THEN 'nowhere' WHEN n_nationkey % 5 = 4 THEN 'center' || (n_nationkey + 1) % 25 END AS ak FROM nation LEFT JOIN c ON c.ck = 'center' || n_nationkey),
p AS (SELECT folder, count(*) AS parts, min(ck) AS part FROM f JOIN c ON contains(ck, fk) GROUP BY 1),
s AS (SELECT folder, ck, count(DISTINCT nk) AS n FROM (SELECT folder, unnest(names) AS nk FROM f) x JOIN r USING (nk) GROUP BY 1, 2),
b AS (SELECT folder, max(n) AS top, max(ck) FILTER (k = 1) AS best, count(*) FILTER (k = 1) AS ties FROM (SELECT *, rank() OVER (PARTITION BY folder ORDER BY n DESC) AS k FROM s) GROUP BY 1)
SELECT folder, CASE WHEN e.ck IS NOT NULL THEN e.ck WHEN ak IS NOT NULL THEN NULL WHEN parts = 1 THEN part WHEN top >= 2 AND ties = 1 THEN best END AS center_key,
CASE WHEN ak IS NOT NULL AND e.ck IS NOT NULL THEN 'alias' WHEN ak IS NOT NULL THEN 'alias_unknown' WHEN e.ck IS NOT NULL THEN 'exact' WHEN parts = 1 THEN 'substring' WHEN top >= 2 AND ties = 1 THEN 'names' ELSE 'unresolved' END AS basis
FROM f LEFT JOIN c e ON e.ck = coalesce(f.ak, f.fk) LEFT JOIN p USING (folder) LEFT JOIN b USING (folder)"""


def _enrolled(spark, sf):
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    owner = F.when(k % 20 == 7, k - 1).otherwise(k)
    ident = F.when(k % 23 == 0, "").otherwise(F.concat(F.lit("P"), F.lpad(owner.cast("string"), 6, "0")))
    name = F.concat(F.lit("PERSON "), F.when(k % 31 == 0, k).otherwise(owner - owner % 3).cast("string"))
    return c.select(k.alias("row"), ident.alias("id"), name.alias("name"))


def _sequence(spark, sf):
    nh = H.normalised(hdr(spark, sf)).where("patient_id <> ''")
    return nh.select(F.col("patient_id").alias("id"), F.col("patient_name").alias("name"), "study_uid").distinct()


def j04_enrolled_studies(spark, sf):
    return M.match_enrolled(_enrolled(spark, sf), _sequence(spark, sf))[0]


def j04_enrolled_exceptions(spark, sf):
    return M.match_enrolled(_enrolled(spark, sf), _sequence(spark, sf))[1]


ENR = """en AS (SELECT c_custkey AS row, CASE WHEN c_custkey % 20 = 7 THEN c_custkey - 1 ELSE c_custkey END AS o FROM customer),
e0 AS (SELECT row, CASE WHEN row % 23 = 0 THEN '' ELSE 'P' || lpad(CAST(o AS VARCHAR), 6, '0') END AS id, 'person' || CASE WHEN row % 31 = 0 THEN row ELSE o - o % 3 END AS nk FROM en),
e1 AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY row) AS nth, first_value(nk) OVER (PARTITION BY id ORDER BY row) AS fn FROM e0),
sq AS (SELECT DISTINCT patient_id AS id, patient_name AS name, study_uid FROM nh WHERE patient_id <> ''),
sn AS (SELECT id, count(DISTINCT study_uid) AS studies, list(DISTINCT lower(replace(name, ' ', ''))) AS names FROM sq GROUP BY 1),
ex AS (SELECT e1.row, e1.id, CASE WHEN e1.id = '' THEN 'missing_id' WHEN nth > 1 AND nk <> fn THEN 'duplicate_id_conflict' WHEN nth > 1 THEN 'duplicate_id' WHEN studies IS NULL THEN 'no_study'
 WHEN NOT list_contains(names, nk) OR len(names) > 1 THEN 'name_mismatch' END AS reason FROM e1 LEFT JOIN sn USING (id))"""
J04 = f"WITH {ENR} SELECT DISTINCT ex.row, ex.id, sq.study_uid FROM ex JOIN sq USING (id) WHERE reason IS NULL"
J04X = f"WITH {ENR} SELECT * FROM ex WHERE reason IS NOT NULL"


def j05_exactly_one(spark, sf):
    r = _registry(spark, sf)[0].select(F.substring("hospital_number", 2, 9).alias("id"), "name_key", F.when(F.col("source_order") % 29 == 0, "").otherwise(F.col("screening_key")).alias("screening_key"))
    c = table(spark, sf, "customer").select((F.col("c_custkey") + 5).cast("string").alias("id"), F.concat(F.lit("person"), (F.col("c_custkey") + 5 - (F.col("c_custkey") + 5) % 3 + F.when(F.col("c_custkey") % 19 == 0, 3).otherwise(0)).cast("string")).alias("name_key"))
    return M.exactly_one(c, r)


J05 = """WITH r AS (SELECT substr(hospital_number, 2, 9) AS id, count(*) AS n, min(lower(replace(patient_name, ' ', ''))) AS nk, min(CASE WHEN source_order % 29 = 0 THEN '' ELSE screening_number END) AS sc FROM registry WHERE hospital_number <> '' GROUP BY 1),
c AS (SELECT CAST(c_custkey + 5 AS VARCHAR) AS id, 'person' || (c_custkey + 5 - (c_custkey + 5) % 3 + CASE WHEN c_custkey % 19 = 0 THEN 3 ELSE 0 END) AS nk FROM customer),
j AS (SELECT c.id, CASE WHEN n IS NULL THEN 'missing' WHEN n > 1 THEN 'not_unique' WHEN r.nk <> c.nk THEN 'name_mismatch' WHEN sc = '' THEN 'missing_screening' ELSE 'matched' END AS status, sc FROM c LEFT JOIN r USING (id))
SELECT id, status, CASE WHEN status = 'matched' THEN sc END AS screening FROM j"""


def j12_unmatched_subjects(spark, sf):
    """Subjects of whom no file of several frames shows one of the four contents."""
    nh = H.normalised(hdr(spark, sf)).where("frames > 1 AND payload = 'pix0'").select(text.bare_name(F.col("patient_name")).alias("name_key"))
    return M.unmatched(_registry(spark, sf)[0], nh, ["name_key"]).select("source_order", "name_key")


J12 = """SELECT min(source_order) AS source_order, lower(replace(patient_name, ' ', '')) AS name_key FROM registry r
WHERE NOT EXISTS (SELECT 1 FROM nh WHERE frames > 1 AND payload = 'pix0' AND lower(replace(nh.patient_name, ' ', '')) = lower(replace(r.patient_name, ' ', ''))) GROUP BY center_name, patient_name, hospital_number, surgery_date, screening_number"""

def _manual(spark, sf):
    r = _registry(spark, sf)[0]
    k, raw = F.col("source_order"), registry(spark, sf)
    first = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("source_order")).agg(F.concat(F.lit("1.2.826."), F.min("o_orderkey").cast("string")).alias("study_uid"))
    raw = raw.join(first, "source_order", "left")
    said = F.when(k % 22 == 0, "No").when(k % 34 == 0, "maybe").when(k % 38 == 0, "").otherwise("是")
    manual = raw.where(k % 2 == 0).select(
        k.alias("row"), F.when(k % 50 == 0, "99-H999").otherwise(F.col("screening_number")).alias("screening"), F.when(k % 28 == 0, "OTHER").otherwise(F.col("patient_name")).alias("name"),
        F.when(k % 46 == 0, "1.2.3").otherwise(F.col("study_uid")).alias("study_uid"), said.alias("confirmation"), F.when(k % 26 == 0, "").otherwise("seen").alias("basis"),
    )
    again = manual.where(F.col("row") % 12 == 4).withColumn("row", F.col("row") + 100000)
    enrolled = raw.where((k % 3 == 0) & (k % 15 != 0)).select(text.bare_name(F.col("patient_name")).alias("name_key"))
    enrolled = enrolled.union(enrolled.where("name_key LIKE '%7'"))
    nh = H.normalised(hdr(spark, sf))
    sequence = nh.select("study_uid", text.bare_name(F.col("patient_name")).alias("name_key"), F.when(F.col("file_size") % 400 == 0, "other").otherwise(F.col("patient_id")).alias("id"))
    regular = raw.where(k % 20 == 16).select(F.when(k % 40 == 16, F.col("screening_number")).otherwise("-").alias("screening"), F.coalesce("study_uid", F.lit("-")).alias("study_uid"))
    return M.bind_manually(manual.union(again), r, enrolled, sequence, None, regular)


def j06_manual_exceptions(spark, sf):
    return _manual(spark, sf)[1]


def j06_manual_bindings(spark, sf):
    return _manual(spark, sf)[0]


MANUAL = """f0 AS (SELECT r.*, lower(replace(patient_name, ' ', '')) AS pk, s.study_uid FROM registry r LEFT JOIN (SELECT o_custkey, '1.2.826.' || min(o_orderkey) AS study_uid FROM orders GROUP BY 1) s ON o_custkey = source_order),
m0 AS (SELECT source_order AS row, CASE WHEN source_order % 50 = 0 THEN '99-H999' ELSE screening_number END AS screening, CASE WHEN source_order % 28 = 0 THEN 'other' ELSE pk END AS nk,
 CASE WHEN source_order % 46 = 0 THEN '1.2.3' ELSE study_uid END AS study_uid, source_order % 34 <> 0 AS yes, source_order % 26 <> 0 AS based FROM f0 WHERE source_order % 2 = 0 AND source_order % 22 <> 0 AND (source_order % 38 <> 0 OR source_order % 34 = 0)),
m AS (SELECT * FROM m0 UNION ALL SELECT * REPLACE (row + 100000 AS row) FROM m0 WHERE row % 12 = 4),
o AS (SELECT DISTINCT center_name, patient_name, hospital_number, surgery_date, screening_number FROM registry),
g AS (SELECT screening_number AS screening, count(*) AS n, min(lower(replace(patient_name, ' ', ''))) AS nk FROM o GROUP BY 1),
e0 AS (SELECT pk AS nk FROM f0 WHERE source_order % 3 = 0 AND source_order % 15 <> 0), e AS (SELECT nk, count(*) AS n FROM (SELECT nk FROM e0 UNION ALL SELECT nk FROM e0 WHERE nk LIKE '%7') GROUP BY 1),
q AS (SELECT study_uid, count(DISTINCT lower(replace(patient_name, ' ', ''))) AS n, min(lower(replace(patient_name, ' ', ''))) AS nk, count(DISTINCT CASE WHEN file_size % 400 = 0 THEN 'other' ELSE nullif(patient_id, '') END) AS ids FROM nh GROUP BY 1),
t AS (SELECT CASE WHEN source_order % 40 = 16 THEN screening_number ELSE '-' END AS ts, coalesce(study_uid, '-') AS tu FROM f0 WHERE source_order % 20 = 16),
a AS (SELECT m.*, CASE WHEN NOT yes THEN 'invalid_confirmation' WHEN NOT based OR m.study_uid IS NULL THEN 'incomplete' WHEN g.n IS NULL THEN 'screening_not_found' WHEN g.n > 1 THEN 'screening_not_unique' WHEN g.nk <> m.nk THEN 'registry_name_mismatch'
 WHEN e.n IS NULL THEN 'enrolled_not_found' WHEN e.n > 1 THEN 'enrolled_not_unique' WHEN q.n IS NULL THEN 'study_not_found' WHEN q.n > 1 OR q.nk <> m.nk THEN 'study_name_mismatch' WHEN ids > 1 THEN 'study_id_conflict'
 WHEN m.screening IN (SELECT ts FROM t) THEN 'screening_taken' WHEN m.study_uid IN (SELECT tu FROM t) THEN 'study_taken' END AS reason
 FROM m LEFT JOIN g USING (screening) LEFT JOIN e ON e.nk = m.nk LEFT JOIN q ON q.study_uid = m.study_uid),
v AS (SELECT row, screening, nk, study_uid, coalesce(reason, CASE WHEN count(DISTINCT CASE WHEN reason IS NULL THEN screening END) OVER (PARTITION BY study_uid) > 1 OR count(DISTINCT CASE WHEN reason IS NULL THEN nk END) OVER (PARTITION BY screening) > 1
 OR count(DISTINCT CASE WHEN reason IS NULL THEN screening END) OVER (PARTITION BY nk) > 1 THEN 'conflicting_bindings' END) AS reason FROM a)"""
J06 = f"WITH {MANUAL} SELECT row, reason FROM v WHERE reason IS NOT NULL"
J06B = f"WITH {MANUAL} SELECT min(row) AS row, screening, min(nk) AS name_key, study_uid, 'seen' AS basis FROM v WHERE reason IS NULL GROUP BY screening, study_uid"


def f08_suffix_conflicts(spark, sf):
    nh = H.normalised(hdr(spark, sf))
    years = F.year("exam_date") - F.year("birth_date")
    c = domain.suffix_conflicts(F.col("sex"), F.col("suffix_sex"), years, dates.age_years(F.col("suffix_age")))
    return nh.select("relative_path", F.array_join(c, ",").alias("conflicts")).where("conflicts <> ''")


F08 = """SELECT relative_path, concat_ws(',', CASE WHEN sex = 'F' AND suffix_sex = 'M' THEN 'suffix_sex' END, CASE WHEN abs(year(exam_date) - year(birth_date) - CASE WHEN suffix_age <> '' THEN 56 END) > 1 THEN 'suffix_age' END) AS conflicts
FROM nh WHERE conflicts <> ''"""


def v03_verified_candidates(spark, sf):
    least = [F.min(c).alias(c) for c in ("study_uid", "series_uid", "sop_uid", "file_size")]
    f = hdr(spark, sf).where("sop_uid <> ''").groupBy("relative_path").agg(*least).withColumn("modified", F.lit("t"))
    k = F.col("file_size")
    e = f.select("relative_path", F.when(k % 11 == 0, "1.9").otherwise(F.col("study_uid")).alias("study_uid"), "series_uid", F.when(k % 13 == 0, "1.8").otherwise(F.col("sop_uid")).alias("sop_uid"), F.when(k % 7 == 0, k + 1).otherwise(k).alias("file_size"), "modified")
    got = P.verify_candidates(f.where("file_size % 5 <> 0"), e)
    return got.groupBy("status", "differ").agg(F.count(F.lit(1)).alias("files"))


V03 = """WITH f AS (SELECT relative_path, min(file_size) AS k FROM hdr WHERE sop_uid <> '' GROUP BY 1)
SELECT CASE WHEN k % 5 = 0 THEN 'source_file_missing' WHEN k % 7 = 0 THEN 'source_changed' WHEN k % 11 = 0 OR k % 13 = 0 THEN 'uid_mismatch' ELSE 'ok' END AS status,
CASE WHEN k % 5 = 0 OR k % 7 = 0 THEN '' ELSE concat_ws(',', CASE WHEN k % 11 = 0 THEN 'study_uid' END, CASE WHEN k % 13 = 0 THEN 'sop_uid' END) END AS differ, count(*) AS files FROM f GROUP BY ALL"""

QUERIES = {
    "s15_repeated_blocks": s15_repeated_blocks,
    "j06_manual_exceptions": j06_manual_exceptions, "j06_manual_bindings": j06_manual_bindings, "f08_suffix_conflicts": f08_suffix_conflicts, "v03_verified_candidates": v03_verified_candidates,
    "a10_center_report": a10_center_report, "a10_report_exceptions": a10_report_exceptions, "s15_registry_exceptions": s15_registry_exceptions, "w01_fill_down": w01_fill_down,
    "j03_center_resolution": j03_center_resolution, "j04_enrolled_studies": j04_enrolled_studies, "j04_enrolled_exceptions": j04_enrolled_exceptions, "j05_exactly_one": j05_exactly_one,
    "j12_unmatched_subjects": j12_unmatched_subjects,
}
ORACLE_SQL = {
    "s15_repeated_blocks": oracle(S15B, "registry"),
    "j06_manual_exceptions": oracle(J06, "nh", "registry"), "j06_manual_bindings": oracle(J06B, "nh", "registry"), "f08_suffix_conflicts": oracle(F08, "nh"), "v03_verified_candidates": oracle(V03, "hdr"),
    "a10_center_report": oracle(A10, "nh", "registry"), "a10_report_exceptions": oracle(A10X, "nh", "registry"), "s15_registry_exceptions": oracle(S15, "registry"), "w01_fill_down": oracle(W01, "registry"),
    "j03_center_resolution": oracle(J03, "registry"), "j04_enrolled_studies": oracle(J04, "nh"), "j04_enrolled_exceptions": oracle(J04X, "nh"), "j05_exactly_one": oracle(J05, "registry"),
    "j12_unmatched_subjects": oracle(J12, "nh", "registry"),
}
