"""Choosing Studies by visit: classes of visit periods, the visit nearest to twelve months, and vetoes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from studyloom.functions import dates, text

SIX, TWELVE, CANDIDATE, PENDING = "6M", "12M", "12M_CANDIDATE", "PENDING"
#: Months at which the classes begin, the last month of a regular twelve-month visit, its centre, and how far apart
#: the periods of one Study may be. Fixed values.
SIX_FROM, TWELVE_FROM, TWELVE_TO, CENTRE, SPREAD = 3.0, 9.0, 15.0, 12.0, 0.05
#: Periods whose rows become rules, and identifiers that stand for none. Fixed values.
BEFORE_SURGERY, DURING_SURGERY = "术前", "术中"
NO_UID = ("NA", "N/A", "NONE", "NULL")


def visit_class(months: Column) -> Column:
    return (
        F.when((months >= SIX_FROM) & (months < TWELVE_FROM), SIX).when((months >= TWELVE_FROM) & (months <= TWELVE_TO), TWELVE)
        .when(months > TWELVE_TO, CANDIDATE).otherwise(PENDING)
    )


def classify(tokens: DataFrame, keys: list[str]) -> DataFrame:
    """tokens(keys, period text) -> keys, visit, months: a Study's class if all its periods have it, else PENDING.
    Twelve-month periods further apart than SPREAD are pending too; of equal classes the month nearest to twelve."""
    m = dates.period_months(F.col("period"))
    d = tokens.withColumn("months", m).withColumn("class", F.when(F.col("months").isNull(), PENDING).otherwise(visit_class(F.col("months"))))
    nearest = F.min(F.struct(F.round(F.abs(F.col("months") - CENTRE), 9).alias("far"), "months"))["months"]
    g = d.groupBy(*keys).agg(F.collect_set("class").alias("classes"), nearest.alias("months"), (F.max("months") - F.min("months")).alias("spread"))
    one = F.size("classes") == 1
    apart = (F.col("classes")[0] != SIX) & (F.col("spread") > SPREAD)
    visit = F.when(one & ~F.coalesce(apart, F.lit(False)), F.col("classes")[0]).otherwise(PENDING)
    return g.select(*keys, visit.alias("visit"), F.when(visit != PENDING, F.col("months")).alias("months"))


def period_rules(rows: DataFrame) -> DataFrame:
    """rows(period, series_uid, sop_uid, ...) -> the rows of the two surgical periods, with selector_field and selector_uid:
    a Series before surgery, an instance during it. An identifier that stands for none, or a null one, is empty."""
    d = rows.withColumn("period", text.clean(text.half_width(F.col("period")))).where(F.col("period").isin(BEFORE_SURGERY, DURING_SURGERY))
    before = F.col("period") == BEFORE_SURGERY
    uid = text.clean(text.half_width(F.when(before, F.col("series_uid")).otherwise(F.col("sop_uid"))))
    field = F.when(before, "SeriesInstanceUID").otherwise("SOPInstanceUID")
    return d.withColumns({"selector_field": field, "selector_uid": F.when(F.upper(uid).isin(*NO_UID), "").otherwise(uid)})


def nearest_visit(studies: DataFrame, patient: list[str]) -> DataFrame:
    """studies(patient, study_uid, visit, months) with status: of a patient's twelve-month visits the nearest to
    twelve is selected; two that are equally near are all pending; six-month visits are selected as they are."""
    far = F.round(F.abs(F.col("months") - CENTRE), 9)
    late = F.col("visit").isin(TWELVE, CANDIDATE)
    d = studies.withColumn("far", F.when(late, far))
    per = W.partitionBy(*patient)
    d = d.withColumn("least", F.min("far").over(per)).withColumn("ties", F.sum(F.when(F.col("far") == F.col("least"), 1).otherwise(0)).over(per))
    status = (
        F.when(F.col("visit") == SIX, "matched").when(~late, "pending").when((F.col("far") == F.col("least")) & (F.col("ties") == 1), "selected")
        .when(F.col("far") == F.col("least"), "tied").otherwise("not_selected")
    )
    return d.withColumn("status", status).drop("far", "least", "ties")


def veto_several(selected: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a key with more than one selected row are vetoed together."""
    n = F.sum((F.col("status") == "selected").cast("int")).over(W.partitionBy(*keys))
    return selected.withColumn("vetoed", (F.col("status") == "selected") & (n > 1))


def veto_differing(plans: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Plans of one key that differ are vetoed, all of them."""
    kinds = plans.groupBy(key).agg(F.count_distinct(F.struct(*columns)).alias("_kinds"))
    return plans.join(kinds, key).withColumn("vetoed", F.col("_kinds") > 1).drop("_kinds")


def first_keeps(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of a key is kept, later ones are duplicates."""
    return rows.withColumn("status", F.when(F.row_number().over(W.partitionBy(*keys).orderBy(*order)) == 1, "kept").otherwise("duplicate"))


def plan_faults(plans: DataFrame) -> DataFrame:
    """plans(code, period, folder) with their faults: a code of three digits or more, a known period, and a folder
    named after both."""
    why = F.array_compact(
        F.array(
            F.when(~F.col("code").rlike("^[0-9]{3,}$"), "code"),
            F.when(~F.col("period").isin(SIX, TWELVE), "period"),
            F.when(F.col("folder") != F.concat_ws("-", "code", "period"), "folder"),
        )
    )
    return plans.withColumn("faults", F.array_join(why, ","))
