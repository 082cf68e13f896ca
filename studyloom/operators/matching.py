"""Matching imaging data to subject registries: unique or not at all. What does not match is told, never guessed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from studyloom.functions import dates, domain, text
from studyloom.operators.headers import common
from studyloom.storage import staged

NA = "NA"


def fill_down(rows: DataFrame, column: str, block: list[str], order: str) -> DataFrame:
    """Empty cells take the last value above them in their block."""
    above = W.partitionBy(*block).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return rows.withColumn(column, F.last(F.when(F.col(column) != "", F.col(column)), True).over(above))


def registry_rows(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Subjects once each, by their whole signature, and what each lacks."""
    keyed = raw.select(
        "*", text.bare_name(F.col("patient_name")).alias("name_key"), text.center_key(F.col("center_name")).alias("center_key"), text.screening_number(F.col("screening_number")).alias("screening_key")
    )
    sign = ["center_key", "name_key", "hospital_number", "surgery_date", "screening_key"]
    once = keyed.groupBy(*sign).agg(F.min(F.struct("source_order", "center_name", "patient_name")).alias("first"))
    once = once.select(*sign, "first.*")
    lacks = F.array_compact(
        F.array(F.when(F.col("name_key") == "", "missing_name"), F.when(F.col("hospital_number") == "", "missing_hospital_number"), F.when(F.col("surgery_date").isNull(), "missing_surgery_date"))
    )
    return once, once.select("source_order", F.explode(lacks).alias("reason"))


def _candidates(registry: DataFrame, key: str, prefix: str) -> DataFrame:
    """Per key: how many different subjects it may mean, and the first of them. Subjects differ in hospital number, surgery date or, if the
    registry has them, initials."""
    who = [c for c in ("hospital_number", "surgery_date", "patient_initials") if c in registry.columns]
    g = registry.where(F.col(key) != "").groupBy(key)
    distinct = F.count_distinct(F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in who]))
    return g.agg(distinct.alias(f"{prefix}_n"), F.min(F.struct("source_order", "hospital_number", "surgery_date")).alias(f"{prefix}_first"))


def _spread(key: Column, rows: DataFrame, by: tuple[str, ...]) -> Column:
    """A join key that is empty for many rows: these get one of a thousand keys that nothing has, by what is in the row's columns ``by``,
    or in all plain ones, which then travel even if nothing else asks for them."""
    plain = by or [c for c, kind in rows.dtypes if not kind.startswith(("map", "array", "struct"))]
    return F.when(F.coalesce(key, F.lit("")) == "", F.concat(F.lit("\x01"), F.pmod(F.xxhash64(*plain), F.lit(1000)).cast("string"))).otherwise(key)


#: Most screening numbers that are sent to all tasks; with more, rows travel to their number. The result is the same.
SENT_NUMBERS = 50_000


def match_registry(files: DataFrame, registry: DataFrame, name: str, screening: str, by: tuple[str, ...] = ()) -> DataFrame:
    """files with hospital_number, surgery_date, source_order and match. By name; only where no subject has the name,
    by screening number. A key that means several subjects matches none. Rows without a key, and those that the name has matched, do not
    meet in the join by number. ``by``: columns that tell rows apart, see ``_spread``."""
    by_name = _candidates(registry, "name_key", "name").withColumnRenamed("name_key", "_name")
    by_number = staged(_candidates(registry, "screening_key", "number").withColumnRenamed("screening_key", "_number"), "numbers")
    d = files.withColumn("_name", _spread(F.col(name), files, by)).join(by_name, "_name", "left")
    open_ = F.when(F.col("name_n").isNull(), F.col(screening))
    if by_number.count() <= SENT_NUMBERS:
        d = d.withColumn("_number", open_).join(F.broadcast(by_number), "_number", "left")
    else:
        d = d.withColumn("_number", _spread(open_, files, by)).join(by_number, "_number", "left")
    match = (
        F.when(F.col("name_n") == 1, "name").when(F.col("name_n") > 1, "ambiguous_name").when(F.col("number_n") == 1, "screening_number")
        .when(F.col("number_n") > 1, "ambiguous_screening_number").otherwise("missing")
    )
    found = F.when(F.col("name_n") == 1, F.col("name_first")).when(F.col("name_n").isNull() & (F.col("number_n") == 1), F.col("number_first"))
    return d.select(*files.columns, match.alias("match"), found["hospital_number"].alias("hospital_number"), found["surgery_date"].alias("surgery_date"), found["source_order"].alias("source_order"))


def stable(column: str, as_text: Column | None = None) -> Column:
    """An aggregate: the only value of a column, NA where there are several or none."""
    c = as_text if as_text is not None else F.col(column)
    some = F.when(c != "", c)
    return F.when(F.min(some) == F.max(some), F.min(some)).otherwise(NA)


#: Kinds of imaging date by rank, and of angles that a report shows where a group has one value.
IMAGING_DATES = ("acquisition_date", "study_date", "series_date")
ANGLES = ("primary_angle", "secondary_angle")


def series_report(nh: DataFrame, registry: DataFrame) -> DataFrame:
    """A row per Series of single frames, and one per instance of several frames: imaging date (the earliest of the first of
    IMAGING_DATES that the group has), subject by registry with the group's commonest name and screening number, period to surgery,
    instances, and in how many ways its files disagree. The identifiers of a group's instances are held together while it is counted."""
    multi = F.coalesce(F.col("frames"), F.lit(1)) > 1
    d = nh.where("sop_uid <> '' AND study_uid <> '' AND series_uid <> ''").withColumn("instance", F.when(multi, F.col("sop_uid")).otherwise(""))
    held = [c for c in IMAGING_DATES if c in nh.columns]
    kinds = lambda c: F.size(F.collect_set(c)).cast("long")  # noqa: E731  a handful in a group
    several = F.coalesce(*[F.when(F.min(c).isNotNull(), kinds(c)) for c in held], F.lit(0).cast("long"))
    # files travel once, as rows: what is known of a group in part is wider than its few files
    g = d.repartition("study_uid", "series_uid").groupBy("study_uid", "series_uid", "instance").agg(
        F.coalesce(*[F.min(c) for c in held]).alias("imaging_date"), F.coalesce(*[F.when(F.min(c).isNotNull(), F.lit(c)) for c in held]).alias("date_kind"), several.alias("dates"),
        stable("modality").alias("modality"), stable("series_description").alias("series_description"), *[stable(c).alias(c) for c in ANGLES if c in nh.columns],
        F.size(F.collect_set("sop_uid")).cast("long").alias("instances"), F.count(F.lit(1)).alias("files"), F.max("frames").alias("frames"),
        F.coalesce(common("screening"), F.lit("")).alias("screening"), common("patient_name").alias("patient_name"),
        F.collect_set(F.when(F.col("patient_name") != "", F.col("patient_name"))).alias("_names"), F.size(F.collect_set(F.when(F.col("screening") != "", F.col("screening")))).alias("screenings"),
        F.size(F.collect_set(F.when(F.col("patient_id") != "", F.col("patient_id")))).alias("ids"),
    )
    g = g.withColumn("name_key", text.bare_name(F.coalesce("patient_name", F.lit(""))))
    g = g.withColumn("names", F.when(F.size("_names") <= 1, F.size("_names")).otherwise(F.size(F.array_distinct(F.transform("_names", text.bare_name))))).drop("_names")
    m = match_registry(g, registry, "name_key", "screening", ("study_uid", "series_uid", "instance"))
    period = F.coalesce(dates.period(F.col("imaging_date"), F.col("surgery_date")), F.lit(NA))
    return m.withColumn("period", period)


def report_exceptions(report: DataFrame) -> DataFrame:
    """Why rows of the report are not whole, by reason."""
    why = F.array_compact(
        F.array(
            F.when(F.col("match").isin("missing", "ambiguous_name", "ambiguous_screening_number"), F.col("match")),
            F.when(F.col("imaging_date").isNull(), "missing_imaging_date"),
            F.when(F.col("dates") > 1, "several_imaging_dates"),
            F.when(F.col("match").isin("name", "screening_number") & F.col("surgery_date").isNull(), "missing_surgery_date"),
            F.when(F.col("names") > 1, "several_names"),
            F.when(F.col("screenings") > 1, "several_screening_numbers"),
            F.when(F.col("ids") > 1, "several_patient_ids"),
            F.when(F.col("files") > F.col("instances"), "repeated_instances"),
        )
    )
    return report.select("study_uid", "series_uid", "instance", F.explode(why).alias("reason"))


def center_parts(centers: DataFrame, longest: int) -> DataFrame:
    """center_key, part: every part of a key of two characters up to the longest that is asked for."""
    start = F.sequence(F.lit(1), F.length("center_key") - 1)
    some = centers.where(F.length("center_key") >= 2).select("center_key").distinct().select("center_key", F.explode(start).alias("at"))
    ends = F.sequence(F.lit(2), F.least(F.length("center_key") - F.col("at") + 1, F.lit(longest)))
    return some.select("center_key", F.explode(F.transform(ends, lambda n: F.substring(F.col("center_key"), F.col("at"), n))).alias("part")).distinct()


def resolve_centers(folders: DataFrame, centers: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """folders(folder, names), centers(center_key, names), aliases(folder, center) -> folder, center_key, basis. The center that an alias
    names (``alias_unknown`` if there is none of that name: nothing else is tried); else the exact key; else the only center whose key
    holds the folder's (two characters at least), not the other way round; else the only center at all; else the center with the most names in
    common, two at least and more than any other.

    The parts of the centers' keys are rows, so that each step is a join by equal keys."""
    f = folders.withColumn("folder_key", text.center_key(F.col("folder")))
    if aliases is None:
        f = f.withColumn("alias_key", F.lit(None).cast("string"))
    else:
        named = aliases.groupBy("folder").agg(F.min(text.center_key(F.col("center"))).alias("alias_key"))
        f = f.join(named, "folder", "left")
    keys = centers.select("center_key").distinct()
    known = keys.select(F.col("center_key").alias("known"))
    f = f.withColumn("wanted", F.coalesce("alias_key", "folder_key")).join(known, F.col("wanted") == F.col("known"), "left").drop("wanted")
    only, total = keys.agg(F.min("center_key"), F.count(F.lit(1))).first()
    longest = f.agg(F.max(F.length("folder_key"))).first()[0] or 0
    part = f.where("known IS NULL AND alias_key IS NULL").select("folder", F.col("folder_key").alias("part")).join(center_parts(centers, max(2, longest)), "part")
    part = part.groupBy("folder").agg(F.count(F.lit(1)).alias("parts"), F.min("center_key").alias("part"))
    shared = f.select("folder", F.explode("names").alias("name")).join(centers.select("center_key", F.explode("names").alias("name")), "name")
    shared = shared.groupBy("folder", "center_key").agg(F.count_distinct("name").alias("n"))
    best = shared.groupBy("folder").agg(F.max(F.struct("n", "center_key")).alias("best"), F.max("n").alias("top"))
    ties = shared.join(best, "folder").where("n = top").groupBy("folder").agg(F.count(F.lit(1)).alias("ties"))
    d = f.join(part, "folder", "left").join(best, "folder", "left").join(ties, "folder", "left")
    alias = F.col("alias_key").isNotNull()
    overlap = (F.col("top") >= 2) & (F.col("ties") == 1)
    basis = (
        F.when(alias & F.col("known").isNotNull(), "alias").when(alias, "alias_unknown").when(F.col("known").isNotNull(), "exact").when(F.col("parts") == 1, "substring")
        .when(F.lit(total == 1), "only_center").when(overlap, "names").otherwise("unresolved")
    )
    key = F.when(basis.isin("alias", "exact"), F.col("known")).when(basis == "substring", F.col("part")).when(basis == "only_center", F.lit(only)).when(basis == "names", F.col("best.center_key"))
    return d.select("folder", key.alias("center_key"), basis.alias("basis"))


def match_enrolled(enrolled: DataFrame, sequence: DataFrame) -> tuple[DataFrame, DataFrame]:
    """enrolled(row, id, name), sequence(id, name, study_uid) -> matched Studies, and exceptions (row, reason): no id,
    an id seen before (a conflict if its name differs), no Study for it, a name that differs."""
    first = W.partitionBy("id").orderBy("row")
    e = enrolled.withColumn("name_key", text.bare_name(F.col("name"))).withColumn("nth", F.row_number().over(first)).withColumn("first_name", F.first("name_key").over(first))
    names = sequence.withColumn("seq_name", text.bare_name(F.col("name"))).groupBy("id").agg(F.count_distinct("study_uid").alias("studies"), F.collect_set("seq_name").alias("seq_names"))
    d = e.join(names, "id", "left")
    reason = (
        F.when(F.col("id") == "", "missing_id")
        .when((F.col("nth") > 1) & (F.col("name_key") != F.col("first_name")), "duplicate_id_conflict")
        .when(F.col("nth") > 1, "duplicate_id")
        .when(F.col("studies").isNull(), "no_study")
        .when(~F.array_contains("seq_names", F.col("name_key")) | (F.size("seq_names") > 1), "name_mismatch")
    )
    d = d.withColumn("reason", reason)
    matched = d.where("reason IS NULL").select("row", "id").join(sequence.select("id", "study_uid").distinct(), "id")
    return matched, d.where("reason IS NOT NULL").select("row", "id", "reason")


def exactly_one(patients: DataFrame, registry: DataFrame) -> DataFrame:
    """patients(id, name_key) with the registry's only row of that id: status matched, missing, not_unique,
    name_mismatch or missing_screening."""
    r = registry.where("id <> ''").groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.min("name_key").alias("reg_name"), F.min("screening_key").alias("screening"))
    d = patients.join(r, "id", "left")
    status = (
        F.when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "not_unique").when(F.col("reg_name") != F.col("name_key"), "name_mismatch")
        .when(F.col("screening") == "", "missing_screening").otherwise("matched")
    )
    return d.select("id", status.alias("status"), F.when(status == "matched", F.col("screening")).alias("screening"))


def unmatched(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of left without a partner."""
    return left.join(right.select(*keys).distinct(), keys, "left_anti")


#: Answers that leave a row of a confirmation table aside. Fixed values.
NO = ("否", "n", "no", "false", "0")


def bind_manually(
    manual: DataFrame, registry: DataFrame, enrolled: DataFrame, sequence: DataFrame, center_code: str | None = None, regular: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Confirmed bindings of Studies whose patients lack an id: manual(row, screening, name, study_uid, confirmation, basis),
    registry(screening_key, name_key) of the center, enrolled(name_key) of rows without id, sequence(study_uid, name_key, id),
    regular(screening, study_uid) of what ids have bound.

    -> bound (row, screening, name_key, study_uid, basis), the first row of each screening number and Study, and exceptions
    (row, reason). Rows that say no or nothing are neither. A row must be complete, of this center, have exactly one partner on each side whose
    names agree, and touch nothing that ids have bound; a Study with several screening numbers, a number with several names and an enrolled
    patient with several numbers veto all their rows."""
    said = F.lower(F.trim(F.coalesce("confirmation", F.lit(""))))
    m = manual.where((said != "") & ~said.isin(*NO)).withColumns({"name_key": text.bare_name(F.col("name")), "screening": text.screening_number(F.col("screening")), "yes": text.is_yes(F.col("confirmation"))})
    reg = registry.where("screening_key <> ''").groupBy(F.col("screening_key").alias("screening")).agg(F.count(F.lit(1)).alias("n_reg"), F.min("name_key").alias("reg_name"))
    enr = enrolled.where("name_key <> ''").groupBy("name_key").agg(F.count(F.lit(1)).alias("n_enr"))
    names, ids = F.when(F.col("name_key") != "", F.col("name_key")), F.when(F.col("id") != "", F.col("id"))
    seq = sequence.where("study_uid <> ''").groupBy("study_uid").agg(F.count_distinct(names).alias("n_seq"), F.min(names).alias("seq_name"), F.count_distinct(ids).alias("n_ids"), F.lit(True).alias("in_seq"))
    regular = regular if regular is not None else manual.sparkSession.createDataFrame([], "screening string, study_uid string")
    taken = lambda c: regular.select(c).distinct().withColumn(f"taken_{c}", F.lit(True))
    d = m.join(reg, "screening", "left").join(enr, "name_key", "left").join(seq, "study_uid", "left").join(taken("screening"), "screening", "left").join(taken("study_uid"), "study_uid", "left")
    other = ~domain.screening_in_center(F.col("screening"), F.lit(center_code)) if center_code else F.lit(False)
    lacks = (F.col("screening") == "") | (F.col("name_key") == "") | (F.coalesce("study_uid", F.lit("")) == "") | (F.trim(F.coalesce("basis", F.lit(""))) == "")
    alone = (
        F.when(~F.col("yes"), "invalid_confirmation").when(lacks, "incomplete").when(other, "other_center").when(F.col("n_reg").isNull(), "screening_not_found").when(F.col("n_reg") > 1, "screening_not_unique")
        .when((F.col("reg_name") != "") & (F.col("reg_name") != F.col("name_key")), "registry_name_mismatch").when(F.col("n_enr").isNull(), "enrolled_not_found").when(F.col("n_enr") > 1, "enrolled_not_unique")
        .when(F.col("in_seq").isNull(), "study_not_found").when((F.col("n_seq") > 1) | (F.col("seq_name") != F.col("name_key")), "study_name_mismatch").when(F.col("n_ids") > 1, "study_id_conflict")
        .when(F.col("taken_screening"), "screening_taken").when(F.col("taken_study_uid"), "study_taken")
    )
    d = d.select("row", "screening", "name_key", "study_uid", "basis", alone.alias("reason"))
    able = d.where("reason IS NULL")
    several = lambda by, what, name: able.groupBy(by).agg(F.count_distinct(what).alias(name))
    d = d.join(several("study_uid", "screening", "_study"), "study_uid", "left").join(several("screening", "name_key", "_number"), "screening", "left").join(several("name_key", "screening", "_person"), "name_key", "left")
    torn = (F.col("_study") > 1) | (F.col("_number") > 1) | (F.col("_person") > 1)
    d = d.select("row", "screening", "name_key", "study_uid", "basis", F.coalesce("reason", F.when(torn, "conflicting_bindings")).alias("reason"))
    bound = d.where("reason IS NULL").groupBy("screening", "study_uid").agg(F.min(F.struct("row", "name_key", "basis")).alias("b"))
    return bound.select("b.row", "screening", "b.name_key", "study_uid", "b.basis"), d.where("reason IS NOT NULL").select("row", "reason")
