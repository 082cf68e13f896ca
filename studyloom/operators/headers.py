"""Header rows: normalised columns, quarantine of rows that lack identifiers, and inventories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studyloom.functions import dates, domain, text

RULE_VERSION = "1"


def normalised(hdr: DataFrame) -> DataFrame:
    """hdr with the columns that all operators use: ids, name and its key, dates, sex, modality, institution key."""
    # columns that several others come of are projections of their own, which the optimizer does not copy into them
    d = hdr.select("*", text.name_parts(F.col("patient_name_raw")).alias("_parts"), dates.valid_date(F.col("study_date_raw")).alias("study_date"), dates.valid_date(F.col("acquisition_date_raw")).alias("acquisition_date"))
    d = d.select("*", text.named(F.col("_parts")).alias("_name"))
    d = d.select("*", text.letters(F.col("_name.name")).alias("_letters"))
    return d.select(
        *hdr.columns,
        text.patient_id(F.col("patient_id_raw")).alias("patient_id"),
        F.col("_name.name").alias("patient_name"),
        F.col("_name.sex").alias("suffix_sex"),
        F.col("_name.age").alias("suffix_age"),
        *([dates.age_text(F.col("patient_age_raw")).alias("age")] if "patient_age_raw" in hdr.columns else []),
        text.no_placeholder(F.col("_letters")).alias("name_key"),
        dates.valid_date(F.col("birth_date_raw")).alias("birth_date"),
        F.coalesce("study_date", "acquisition_date").alias("exam_date"),
        "study_date",
        "acquisition_date",
        domain.sex(F.col("sex_raw")).alias("sex"),
        domain.modality(F.col("modality_raw")).alias("modality"),
        text.institution_key(F.col("institution_raw")).alias("institution_key"),
        F.col("number_of_frames_raw").try_cast("int").alias("frames"),
    )


def has_uids() -> Column:
    return (F.col("study_uid") != "") & (F.col("series_uid") != "") & (F.col("sop_uid") != "")


def complete(hdr: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with all three identifiers, and those to quarantine with what they lack."""
    lack = F.array_join(F.array_compact(F.array(*[F.when(F.col(c) == "", c) for c in ("study_uid", "series_uid", "sop_uid")])), ",")
    return hdr.where(has_uids()), hdr.where(~has_uids()).select("relative_path", lack.alias("missing"))


def patient_inventory(nh: DataFrame) -> DataFrame:
    """A row per ``ID:`` key, or ``NAME:`` key where the id is missing: files, the commonest name (ties: least) and
    how many other names there are. Names are counted before patients are, so a patient's rows never meet."""
    key = F.when(F.col("patient_id") != "", F.concat(F.lit("ID:"), F.col("patient_id"))).otherwise(F.concat(F.lit("NAME:"), F.col("name_key")))
    by_name = nh.groupBy(key.alias("patient_key"), "patient_name").agg(F.count(F.lit(1)).alias("n"))
    named = F.col("patient_name") != ""
    return by_name.groupBy("patient_key").agg(
        F.sum("n").alias("files"),
        F.coalesce(F.min(F.when(named, F.struct((-F.col("n")).alias("n"), "patient_name")))["patient_name"], F.lit("")).alias("preferred_name"),
        F.greatest(F.sum(named.cast("int")) - 1, F.lit(0)).cast("long").alias("aliases"),
    )


def common(column: str) -> Column:
    """An aggregate: the commonest value that is neither null nor empty, the least of equals."""
    return F.mode(F.when(F.col(column).cast("string") != "", F.col(column)), True)


def modal(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """keys and the commonest value of each column, in one pass."""
    return df.groupBy(*keys).agg(*[common(c).alias(c) for c in columns])


def series_summary(nh: DataFrame) -> DataFrame:
    """A row per Study and Series: distinct instances, frames, dates, kind, and the tomography decision."""
    s = nh.where(has_uids()).groupBy("study_uid", "series_uid").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("sop_uid").alias("file_count"),
        F.max(F.coalesce("frames", F.lit(1))).alias("max_frames"),
        F.min("exam_date").alias("exam_date"),
        F.array_sort(F.collect_set("modality")).alias("modalities"),
        F.bool_or(F.col("modality") == "XA").alias("xa"),
        F.bool_or(F.col("modality").isin("CT", "MR")).alias("known"),
        F.bool_or(F.col("slice_thickness_raw") != "").alias("thick"),
        F.bool_or(F.col("series_description").rlike(domain.RECON)).alias("recon"),
    )
    s = s.withColumn("is_3d", domain.tomography(F.col("xa"), F.col("thick"), F.col("recon")))
    return s.withColumn("confidence", domain.confidence(F.col("xa"), F.col("is_3d"), F.col("known")))


def study_summary(series: DataFrame) -> DataFrame:
    """A row per Study: its Series and distinct instances, first date, modalities as displayed, and confidence: the
    highest of its tomographic Series, else the lowest of all."""
    has_3d = F.bool_or("is_3d")
    kinds = F.array_distinct(F.flatten(F.collect_set("modalities")))
    return series.groupBy("study_uid").agg(
        F.min("exam_date").cast("string").alias("exam_date"),
        F.count(F.lit(1)).alias("series_count"),
        F.sum("file_count").alias("file_count"),
        has_3d.cast("int").alias("has_3d"),
        F.when(has_3d, F.max(F.when(F.col("is_3d"), F.col("confidence")))).otherwise(F.min("confidence")).alias("confidence"),
        domain.display_type(kinds, has_3d).alias("display_type"),
    )


def quality_warnings(nh: DataFrame, grain: str = "study_uid") -> DataFrame:
    """(grain, warning, n): several patient ids, several exam dates, none at all."""
    g = nh.groupBy(grain).agg(
        F.size(F.collect_set(F.when(F.col("patient_id") != "", F.col("patient_id")))).cast("long").alias("ids"), F.size(F.collect_set("exam_date")).cast("long").alias("dates")
    )
    found = F.array_compact(
        F.array(
            F.when(F.col("ids") > 1, F.struct(F.lit("multiple_patient_ids").alias("warning"), F.col("ids").alias("n"))),
            F.when(F.col("dates") > 1, F.struct(F.lit("multiple_dates").alias("warning"), F.col("dates").alias("n"))),
            F.when(F.col("dates") == 0, F.struct(F.lit("no_date").alias("warning"), F.lit(0).cast("long").alias("n"))),
        )
    )
    return g.select(grain, F.explode(found).alias("w")).select(grain, "w.*")


def repeated(nh: DataFrame, key: str = "sop_uid") -> DataFrame:
    """Keys that occur more than once, with how many payloads they have."""
    g = nh.where(F.col(key) != "").groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("payload").alias("payloads"))
    return g.where("n > 1")


def unique_values(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Per group each column's only value. If any column has several, all are empty (multiple_values); rows that
    lack a value do not count against it, but are told (partial_missing, missing_tag)."""
    aggs = []
    for c in columns:
        there = F.when(F.col(c) != "", F.col(c))
        aggs += [F.min(there).alias(f"_{c}"), (F.min(there) != F.max(there)).alias(f"more_{c}"), F.count(there).alias(f"held_{c}")]
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), *aggs)
    any_of = lambda test: sum((F.when(test(c), 1).otherwise(0) for c in columns), F.lit(0)) > 0
    several = any_of(lambda c: F.col(f"more_{c}"))
    none = any_of(lambda c: F.col(f"held_{c}") == 0)
    some = any_of(lambda c: F.col(f"held_{c}") < F.col("rows"))
    status = F.when(several, "multiple_values").when(none, "missing_tag").when(some, "partial_missing").otherwise("ok")
    values = [F.when(several, "").otherwise(F.coalesce(f"_{c}", F.lit(""))).alias(c) for c in columns]
    return g.select(*keys, "rows", *values, status.alias("status"))
