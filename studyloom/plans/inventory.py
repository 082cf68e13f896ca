"""Queries over header rows: normalisation, inventories, Series and Study summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studyloom.functions import dates, domain, text
from studyloom.operators import headers as H
from studyloom.plans.adapters import hdr, oracle, table


def _nh(spark: SparkSession, sf: str) -> DataFrame:
    return H.normalised(hdr(spark, sf))


def n_header_keys(spark, sf):
    nh = _nh(spark, sf)
    return nh.select(
        "relative_path", "patient_id", "patient_name", "suffix_sex", "suffix_age", "name_key", F.col("birth_date").cast("string").alias("birth_date"),
        F.col("exam_date").cast("string").alias("exam_date"), "sex", "modality", "institution_key",
        text.path_hash(F.col("relative_path")).alias("path_hash"),
        F.coalesce(dates.compact_date(F.col("exam_date")), F.lit(-1)).alias("exam_int"),
        dates.age_years(F.col("suffix_age")).cast("int").alias("suffix_years"),
    )


N_HEADER_KEYS = """SELECT relative_path, patient_id, patient_name, suffix_sex, suffix_age, name_key, CAST(birth_date AS VARCHAR) AS birth_date,
CAST(exam_date AS VARCHAR) AS exam_date, sex, modality, institution_key, sha256(relative_path) AS path_hash,
coalesce(CAST(strftime(exam_date, '%Y%m%d') AS INTEGER), -1) AS exam_int, CASE WHEN suffix_age <> '' THEN 56 END AS suffix_years FROM nh"""


def f02_quarantine(spark, sf):
    return H.complete(hdr(spark, sf))[1]


F02 = "SELECT relative_path, 'sop_uid' AS missing FROM hdr WHERE sop_uid = ''"


def f03_uid_reasons(spark, sf):
    n = lambda c: F.array_join(domain.uid_reasons(F.col(c)), ",").alias(f"{c}_reasons")
    return hdr(spark, sf).select("relative_path", n("study_uid"), n("series_uid"), n("sop_uid"), domain.path_unsafe(F.col("sop_uid")).alias("unsafe"))


F03 = r"""SELECT relative_path, '' AS study_uid_reasons, '' AS series_uid_reasons,
CASE WHEN sop_uid = '' THEN 'missing' ELSE '' END AS sop_uid_reasons, sop_uid = '' AS unsafe FROM hdr"""


def a01_patient_inventory(spark, sf):
    return H.patient_inventory(_nh(spark, sf))


A01 = """WITH n AS (SELECT CASE WHEN patient_id <> '' THEN 'ID:' || patient_id ELSE 'NAME:' || name_key END AS patient_key, patient_name, count(*) AS n FROM nh GROUP BY ALL)
SELECT patient_key, CAST(sum(n) AS BIGINT) AS files, first(patient_name ORDER BY n DESC, patient_name) AS preferred_name, count(*) - 1 AS aliases FROM n GROUP BY patient_key"""


def a02_modal_values(spark, sf):
    out = H.modal(_nh(spark, sf).where("patient_id <> ''"), ["patient_id"], ["birth_date", "sex", "institution_key"])
    return out.withColumn("birth_date", F.col("birth_date").cast("string"))


A02 = """WITH p AS (SELECT DISTINCT patient_id FROM nh WHERE patient_id <> ''),
b AS (SELECT patient_id, birth_date AS v, count(*) AS n FROM nh WHERE birth_date IS NOT NULL GROUP BY ALL), b1 AS (SELECT patient_id, first(v ORDER BY n DESC, v) AS v FROM b GROUP BY 1),
s AS (SELECT patient_id, sex AS v, count(*) AS n FROM nh WHERE sex <> '' GROUP BY ALL), s1 AS (SELECT patient_id, first(v ORDER BY n DESC, v) AS v FROM s GROUP BY 1),
i AS (SELECT patient_id, institution_key AS v, count(*) AS n FROM nh WHERE institution_key <> '' GROUP BY ALL), i1 AS (SELECT patient_id, first(v ORDER BY n DESC, v) AS v FROM i GROUP BY 1)
SELECT p.patient_id, CAST(b1.v AS VARCHAR) AS birth_date, s1.v AS sex, i1.v AS institution_key FROM p LEFT JOIN b1 USING (patient_id) LEFT JOIN s1 USING (patient_id) LEFT JOIN i1 USING (patient_id)"""

_RECON = "(?i)3D|MIP|MPR|VRT?|RECON|VOLUME|DYNACT|CBCT|XPERCT|断层|重建"
SERIES = f"""ser AS (SELECT study_uid, series_uid, count(*) AS rows, count(DISTINCT sop_uid) AS file_count, max(coalesce(frames, 1)) AS max_frames, min(exam_date) AS exam_date,
list_sort(list(DISTINCT modality)) AS modalities, bool_or(modality = 'XA') AS xa, bool_or(modality IN ('CT', 'MR')) AS known, bool_or(slice_thickness_raw <> '') AS thick,
bool_or(regexp_matches(series_description, '{_RECON}')) AS recon FROM nh WHERE sop_uid <> '' GROUP BY study_uid, series_uid),
cls AS (SELECT *, xa AND thick AND recon AS is_3d, CASE WHEN xa AND thick AND recon THEN 82 WHEN xa THEN 72 WHEN known THEN 99 ELSE 60 END AS confidence FROM ser)"""


def a03_series_summary(spark, sf):
    s = H.series_summary(_nh(spark, sf))
    return s.select("study_uid", "series_uid", "rows", "file_count", "max_frames", F.col("exam_date").cast("string").alias("exam_date"), F.array_join("modalities", "+").alias("modalities"), F.col("is_3d").cast("int").alias("is_3d"), "confidence")


A03 = f"WITH {SERIES} SELECT study_uid, series_uid, rows, file_count, max_frames, CAST(exam_date AS VARCHAR) AS exam_date, array_to_string(modalities, '+') AS modalities, CAST(is_3d AS INTEGER) AS is_3d, confidence FROM cls"


def a04_study_summary(spark, sf):
    return H.study_summary(H.series_summary(_nh(spark, sf)))


A04 = f"""WITH {SERIES}, m AS (SELECT study_uid, bool_or('XA' = m) AS xa, bool_or('CT' = m) AS ct, bool_or('MR' = m) AS mr FROM (SELECT study_uid, unnest(modalities) AS m FROM cls) GROUP BY 1)
SELECT study_uid, CAST(min(exam_date) AS VARCHAR) AS exam_date, count(*) AS series_count, CAST(sum(file_count) AS BIGINT) AS file_count, CAST(bool_or(is_3d) AS INTEGER) AS has_3d,
CASE WHEN bool_or(is_3d) THEN max(CASE WHEN is_3d THEN confidence END) ELSE min(confidence) END AS confidence,
array_to_string(list_filter([CASE WHEN any_value(m.xa) THEN CASE WHEN bool_or(is_3d) THEN 'XA（含3D_DSA断层）' ELSE 'XA' END END, CASE WHEN any_value(m.ct) THEN 'CT' END, CASE WHEN any_value(m.mr) THEN 'MR' END], lambda x: x IS NOT NULL), '、') AS display_type
FROM cls JOIN m USING (study_uid) GROUP BY study_uid"""


def a05_study_warnings(spark, sf):
    return H.quality_warnings(_nh(spark, sf))


A05 = """WITH g AS (SELECT study_uid, count(DISTINCT CASE WHEN patient_id <> '' THEN patient_id END) AS ids, count(DISTINCT exam_date) AS dates FROM nh GROUP BY 1)
SELECT study_uid, 'multiple_patient_ids' AS warning, ids AS n FROM g WHERE ids > 1 UNION ALL SELECT study_uid, 'multiple_dates', dates FROM g WHERE dates > 1 UNION ALL SELECT study_uid, 'no_date', 0 FROM g WHERE dates = 0"""


def a13_unique_equipment(spark, sf):
    return H.unique_values(hdr(spark, sf), ["study_uid", "series_uid"], ["modality_raw", "slice_thickness_raw"])


A13 = """WITH g AS (SELECT study_uid, series_uid, count(*) AS rows, min(modality_raw) AS m, count(DISTINCT modality_raw) AS nm,
min(CASE WHEN slice_thickness_raw <> '' THEN slice_thickness_raw END) AS t, count(DISTINCT CASE WHEN slice_thickness_raw <> '' THEN slice_thickness_raw END) AS nt,
count(CASE WHEN slice_thickness_raw <> '' THEN 1 END) AS ht FROM hdr GROUP BY 1, 2)
SELECT study_uid, series_uid, rows, CASE WHEN nm > 1 OR nt > 1 THEN '' ELSE m END AS modality_raw, CASE WHEN nm > 1 OR nt > 1 THEN '' ELSE coalesce(t, '') END AS slice_thickness_raw,
CASE WHEN nm > 1 OR nt > 1 THEN 'multiple_values' WHEN nt = 0 THEN 'missing_tag' WHEN ht < rows THEN 'partial_missing' ELSE 'ok' END AS status FROM g"""


def a16_series_ledger(spark, sf):
    return hdr(spark, sf).where(H.has_uids()).groupBy("source_subject", "study_uid", "series_uid").agg(F.count(F.lit(1)).alias("file_count"))


A16 = "SELECT source_subject, study_uid, series_uid, count(*) AS file_count FROM hdr WHERE sop_uid <> '' GROUP BY ALL"


def a17_status_rollup(spark, sf):
    h = hdr(spark, sf)
    status = F.when(F.col("sop_uid") == "", "quarantined").when(F.col("patient_id_raw") == "", "unidentified").otherwise("ready")
    return h.withColumn("status", status).groupBy("source_subject").pivot("status", ["quarantined", "unidentified", "ready"]).count().na.fill(0)


A17 = """SELECT source_subject, count(*) FILTER (sop_uid = '') AS quarantined, count(*) FILTER (sop_uid <> '' AND patient_id_raw = '') AS unidentified,
count(*) FILTER (sop_uid <> '' AND patient_id_raw <> '') AS ready FROM hdr GROUP BY 1"""


def a18_repeated_sops(spark, sf):
    return H.repeated(hdr(spark, sf))


A18 = "SELECT sop_uid, count(*) AS n, count(DISTINCT payload) AS payloads FROM hdr WHERE sop_uid <> '' GROUP BY 1 HAVING count(*) > 1"


def a21_first_seen_join(spark, sf):
    d = hdr(spark, sf)
    return d.groupBy("study_uid").agg(text.first_seen_join(F.col("modality_raw"), F.col("relative_path"), "|").alias("modalities"))


A21 = """WITH f AS (SELECT study_uid, modality_raw, min(relative_path) AS pos FROM hdr GROUP BY 1, 2)
SELECT study_uid, string_agg(modality_raw, '|' ORDER BY pos) AS modalities FROM f GROUP BY 1"""


def o01_study_order(spark, sf):
    """Studies in report order: date with missing last, then identifier; the place is part of the row. Places are
    counted inside date groups, whose offsets come from an aggregate, so no task sorts all Studies."""
    from pyspark.sql import Window as W

    s = H.study_summary(H.series_summary(_nh(spark, sf))).select("study_uid", "exam_date")
    before = W.orderBy(F.col("exam_date").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    days = s.groupBy("exam_date").agg(F.count(F.lit(1)).alias("held")).withColumn("before", F.coalesce(F.sum("held").over(before), F.lit(0)))
    s = s.withColumn("at", F.row_number().over(W.partitionBy("exam_date").orderBy("study_uid")))
    out = s.alias("s").join(days.alias("d"), F.col("s.exam_date").eqNullSafe(F.col("d.exam_date")))
    return out.select("s.study_uid", "s.exam_date", (F.col("before") + F.col("at")).alias("place"))


O01 = """WITH s AS (SELECT study_uid, CAST(min(exam_date) AS VARCHAR) AS exam_date FROM nh WHERE sop_uid <> '' GROUP BY 1)
SELECT study_uid, exam_date, row_number() OVER (ORDER BY exam_date NULLS LAST, study_uid) AS place FROM s"""


def n22_image_types(spark, sf):
    d = table(spark, sf, "part").select("p_partkey", F.concat_ws("_", "p_name", "p_type", F.when(F.col("p_size") % 3 == 0, "ncct_CTP").when(F.col("p_size") % 3 == 1, "dsa").otherwise("scan")).alias("name"))
    return d.select(F.col("p_partkey"), text.image_type(F.col("name")).alias("image_type"), text.path_component(F.concat("name", F.lit(" /:? . "))).alias("folder"), text.code_text(F.col("p_partkey")).alias("code"))


N22 = r"""WITH d AS (SELECT p_partkey, concat_ws('_', p_name, p_type, CASE p_size % 3 WHEN 0 THEN 'ncct_CTP' WHEN 1 THEN 'dsa' ELSE 'scan' END) AS name FROM part),
t AS (SELECT *, list_transform(regexp_extract_all(upper(name), 'NCCT|CTTP|CTP|CTA|DSA|CT'), lambda x: CASE x WHEN 'NCCT' THEN 'CT' WHEN 'CTTP' THEN 'CTP' ELSE x END) AS k FROM d),
u AS (SELECT *, list_filter(k, lambda x, i: list_position(k, x) = i) AS kk FROM t)
SELECT p_partkey, CASE WHEN len(kk) > 0 THEN array_to_string(kk, '+') ELSE 'REVIEW' END AS image_type,
regexp_replace(regexp_replace(trim(name || ' /:? . '), '[<>:"/\\|?*]', '_', 'g'), '[. ]+$', '') AS folder,
CASE WHEN p_partkey <= 0 THEN NULL WHEN length(CAST(p_partkey AS VARCHAR)) < 3 THEN lpad(CAST(p_partkey AS VARCHAR), 3, '0') ELSE CAST(p_partkey AS VARCHAR) END AS code FROM u"""



def n43_image_type_lists(spark, sf):
    h = hdr(spark, sf).where("slice_thickness_raw <> ''")
    words = F.split("series_description", " ")
    return h.groupBy(domain.image_type(words).alias("image_type")).agg(F.count(F.lit(1)).alias("files"))


N43 = """SELECT '[' || array_to_string(list_transform(string_split(series_description, ' '), lambda w: '''' || w || ''''), ', ') || ']' AS image_type, count(*) AS files
FROM hdr WHERE slice_thickness_raw <> '' GROUP BY 1"""

QUERIES = {
    "n_header_keys": n_header_keys, "f02_quarantine": f02_quarantine, "f03_uid_reasons": f03_uid_reasons, "a01_patient_inventory": a01_patient_inventory,
    "a02_modal_values": a02_modal_values, "a03_series_summary": a03_series_summary, "a04_study_summary": a04_study_summary, "a05_study_warnings": a05_study_warnings,
    "a13_unique_equipment": a13_unique_equipment, "a16_series_ledger": a16_series_ledger, "a17_status_rollup": a17_status_rollup, "a18_repeated_sops": a18_repeated_sops,
    "a21_first_seen_join": a21_first_seen_join, "o01_study_order": o01_study_order, "n22_image_types": n22_image_types, "n43_image_type_lists": n43_image_type_lists,
}
ORACLE_SQL = {
    "n_header_keys": oracle(N_HEADER_KEYS, "nh"), "f02_quarantine": oracle(F02, "hdr"), "f03_uid_reasons": oracle(F03, "hdr"), "a01_patient_inventory": oracle(A01, "nh"),
    "a02_modal_values": oracle(A02, "nh"), "a03_series_summary": oracle(A03, "nh"), "a04_study_summary": oracle(A04, "nh"), "a05_study_warnings": oracle(A05, "nh"),
    "a13_unique_equipment": oracle(A13, "hdr"), "a16_series_ledger": oracle(A16, "hdr"), "a17_status_rollup": oracle(A17, "hdr"), "a18_repeated_sops": oracle(A18, "hdr"),
    "a21_first_seen_join": oracle(A21, "hdr"), "o01_study_order": oracle(O01, "nh"), "n22_image_types": N22, "n43_image_type_lists": oracle(N43, "hdr"),
}
