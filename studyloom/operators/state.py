"""Versioned state: upserts of the Study inventory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studyloom.functions import text


def _pick(prev: Column, cur: Column, merged: Column, replace: Column) -> Column:
    return F.when(prev.isNull(), cur).when(cur.isNull(), prev).when(replace, cur).otherwise(merged)


def upsert_studies(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Both (study_uid, patient_ids, modalities, exam_date, has_3d, confidence, series_count, file_count, evidence,
    rule_version) -> one row per Study, and what happened to it.

    Lists are united, dates take the earlier, counts the higher. A changed rule version replaces has_3d and
    confidence, otherwise they only grow. Joined evidence is split before it is united, so a rerun changes nothing."""
    p, c = previous.alias("p"), current.alias("c")
    d = p.join(c, F.col("p.study_uid") == F.col("c.study_uid"), "full_outer")
    at = lambda name: (F.col(f"p.{name}"), F.col(f"c.{name}"))
    replace = F.col("p.rule_version") != F.col("c.rule_version")
    never = F.lit(False)
    joined = {n: _pick(*at(n), text.merge_joined(*at(n)), never).alias(n) for n in ("patient_ids", "modalities", "evidence")}
    higher = {n: _pick(*at(n), F.greatest(*at(n)), never).alias(n) for n in ("series_count", "file_count")}
    return d.select(
        F.coalesce("p.study_uid", "c.study_uid").alias("study_uid"),
        *joined.values(),
        _pick(*at("exam_date"), F.least(*at("exam_date")), never).alias("exam_date"),
        _pick(*at("has_3d"), F.greatest(*at("has_3d")), replace).alias("has_3d"),
        _pick(*at("confidence"), F.greatest(*at("confidence")), replace).alias("confidence"),
        *higher.values(),
        F.coalesce("c.rule_version", "p.rule_version").alias("rule_version"),
        F.when(F.col("p.study_uid").isNull(), "added").when(F.col("c.study_uid").isNull(), "kept").otherwise("merged").alias("action"),
    )
