"""Views of the given tables in the shape of imaging data, in SQL that Spark and DuckDB both run.

``hdr`` has a row per imaging file header, ``registry`` a row per subject.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

HDR = """
SELECT 'src' || CAST(o_custkey % 7 AS STRING) || '/' || CAST(l_orderkey AS STRING) || '/' ||
       CAST(l_linenumber AS STRING) || '_' || CAST(l_partkey AS STRING) || '_' || CAST(l_suppkey AS STRING) AS relative_path,
       'src' || CAST(o_custkey % 7 AS STRING) AS source_subject,
       CASE WHEN o_custkey % 97 = 0 THEN '' ELSE 'P' || LPAD(CAST(o_custkey AS STRING), 6, '0') END
         || CASE WHEN o_custkey % 5 = 0 AND o_custkey % 97 <> 0 THEN '!12345678-1234-1234-1234-123456789abc' ELSE '' END AS patient_id_raw,
       'PERSON^' || CAST(o_custkey - o_custkey % 3 AS STRING)
         || CASE WHEN o_custkey % 3 = 1 THEN ' M-56Y^^^^' ELSE '' END AS patient_name_raw,
       CASE WHEN o_custkey % 7 = 0 THEN ''
            WHEN o_custkey % 10 = 0 THEN '19300101'
            ELSE CAST(1940 + (o_custkey - o_custkey % 3) % 50 AS STRING) || '0101' END AS birth_date_raw,
       CASE WHEN o_custkey % 11 = 0 THEN '' WHEN (o_custkey - o_custkey % 3) % 2 = 0 THEN 'F' ELSE 'M' END AS sex_raw,
       'INST ' || CAST((o_custkey - o_custkey % 3) % 5 AS STRING) AS institution_raw,
       CASE WHEN o_orderkey % 13 = 0 THEN '' WHEN o_orderkey % 101 = 0 THEN '20250230'
            ELSE REPLACE(CAST(CAST(o_orderdate AS DATE) AS STRING), '-', '') END AS study_date_raw,
       REPLACE(CAST(CAST(l_shipdate AS DATE) AS STRING), '-', '') AS acquisition_date_raw,
       '1.2.826.' || CAST(l_orderkey AS STRING) AS study_uid,
       '1.2.826.' || CAST(l_orderkey AS STRING) || '.' || CAST(l_suppkey % 3 AS STRING) AS series_uid,
       CASE WHEN l_partkey % 211 = 0 THEN '' ELSE '1.2.826.' || CAST(l_orderkey AS STRING) || '.' || CAST(l_suppkey % 3 AS STRING)
         || '.' || CAST(l_linenumber AS STRING) END AS sop_uid,
       CASE l_returnflag WHEN 'R' THEN 'XA' WHEN 'A' THEN 'CT' ELSE 'MRI' END AS modality_raw,
       CASE WHEN p_type = 'LARGE' THEN '3D MIP RECON' WHEN p_type = 'SMALL' THEN 'cbct' ELSE 'DSA ' || p_name END AS series_description,
       CASE WHEN l_discount > 0.045 THEN '0.5' ELSE '' END AS slice_thickness_raw,
       CASE WHEN l_quantity >= 41 THEN CAST(CAST(l_quantity AS INT) AS STRING) ELSE '' END AS number_of_frames_raw,
       CASE WHEN o_custkey % 4 <> 1 THEN '' WHEN o_custkey % 29 = 0 THEN CASE WHEN l_linenumber % 2 = 0 THEN '005Y' ELSE '070Y' END
            ELSE LPAD(CAST(CAST(SUBSTR(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 4) AS INT) - 1940 - (o_custkey - o_custkey % 3) % 50 AS STRING), 3, '0') || 'Y' END AS patient_age_raw,
       CASE WHEN o_custkey % 6 = 0 AND l_linenumber % 3 = 0 THEN 'PERSON ' || CAST(o_custkey - o_custkey % 12 AS STRING) ELSE '' END AS folder_name,
       'pix' || CAST(l_partkey % 4 AS STRING) AS payload,
       CAST(floor(l_extendedprice) AS BIGINT) AS file_size
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey
"""

REGISTRY = """
SELECT 'CENTER ' || CAST(c_nationkey AS STRING) AS center_name,
       'PERSON ' || CAST(c_custkey - c_custkey % 3 AS STRING) AS patient_name,
       CASE WHEN c_custkey % 17 = 0 THEN '' ELSE 'H' || CAST(c_custkey AS STRING) END AS hospital_number,
       LPAD(CAST(c_nationkey AS STRING), 2, '0') || '-H' || LPAD(CAST(c_custkey % 1000 AS STRING), 3, '0') AS screening_number,
       first_order AS surgery_date, c_custkey AS source_order
FROM {customer} LEFT JOIN (SELECT o_custkey, MIN(CAST(o_orderdate AS DATE)) AS first_order FROM {orders} GROUP BY o_custkey) f ON c_custkey = o_custkey
"""

TABLES = ("lineitem", "orders", "part", "customer", "events", "documents", "nation", "region", "supplier", "labels")


def _tables(spark: SparkSession, sf_dir: str, sql: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f"{{{t}}}" in sql}


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return spark.sql(sql, **_tables(spark, sf_dir, sql))


def hdr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, HDR)


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, REGISTRY)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def oracle(sql: str, *views: str) -> str:
    """DuckDB SQL over the named views."""
    plain = {t: t for t in TABLES}
    texts = {"hdr": HDR, "registry": REGISTRY} | NORMAL
    need: list[str] = []
    for v in views:
        for dep in DEPENDS.get(v, ()):
            if dep not in need:
                need.append(dep)
        if v not in need:
            need.append(v)
    head = ",\n".join(f"{v} AS ({texts[v].format(**plain) if v in ('hdr', 'registry') else texts[v]})" for v in need)
    body = sql.strip()
    loops = body.upper().startswith("WITH RECURSIVE")
    start = "WITH RECURSIVE" if loops else "WITH"
    return f"{start} {head}{',' + body[len(start):] if body.upper().startswith('WITH') else ' ' + body}"


#: DuckDB's form of ``studyloom.operators.headers.normalised``: what the operators below start from.
NORMAL = {
    "nh": r"""
SELECT *, regexp_replace(trim(patient_id_raw), '^(.+?)![0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$', '\1') AS patient_id,
  regexp_replace(regexp_replace(trim(regexp_replace(patient_name_raw, '[\^ ]+', ' ', 'g')), '[ ,;._-]+$', ''), ' M-56Y$', '') AS patient_name,
  CASE WHEN patient_name_raw LIKE '% M-56Y%' THEN 'M' ELSE '' END AS suffix_sex,
  CASE WHEN patient_name_raw LIKE '% M-56Y%' THEN '056Y' ELSE '' END AS suffix_age, patient_age_raw AS age,
  lower(regexp_replace(regexp_replace(trim(regexp_replace(patient_name_raw, '[\^ ]+', ' ', 'g')), ' M-56Y$', ''), '[^A-Za-z0-9]', '', 'g')) AS name_key,
  CAST(try_strptime(CASE WHEN birth_date_raw = '' THEN NULL ELSE birth_date_raw END, '%Y%m%d') AS DATE) AS birth_date,
  coalesce(CAST(try_strptime(study_date_raw, '%Y%m%d') AS DATE), CAST(try_strptime(acquisition_date_raw, '%Y%m%d') AS DATE)) AS exam_date,
  CAST(try_strptime(study_date_raw, '%Y%m%d') AS DATE) AS study_date,
  CAST(try_strptime(acquisition_date_raw, '%Y%m%d') AS DATE) AS acquisition_date,
  sex_raw AS sex, CASE WHEN modality_raw = 'MRI' THEN 'MR' ELSE modality_raw END AS modality,
  lower(regexp_replace(institution_raw, '[^A-Za-z0-9]', '', 'g')) AS institution_key,
  try_cast(number_of_frames_raw AS INTEGER) AS frames FROM hdr""",
}
DEPENDS = {"nh": ("hdr",)}
