"""Resolving patient identity: profiles per patient id, blocked pair relations, groups, routes and audits.

What files say of a patient id is counted in a table that adds up over runs; a profile is read off it. Pairs are formed only inside a
block of one name key, never across all patients. A block's pairs are real candidates for one person.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from studyloom.functions import dates, domain, text
from studyloom.operators.components import connected_components
from studyloom.operators.order import code, highest, numbered

#: Years by which an estimated birth year may differ.
TOLERANCE = 1.25


#: What is counted of a patient id. The names are in the order in which they are trusted.
NAMES = ("trusted_name", "subject_name", "header_name")


def evidence(nh: DataFrame) -> DataFrame:
    """patient_id, kind, value, n: how many files say what of a patient id. Such tables of several runs add up (``add_evidence``).

    Kinds: the names that its own folders (``folder_name``, if there) and its headers give, raw header names, birth dates, sexes,
    institutions, birth years by age, source folders, Studies, files, and contradictions inside one header. Headers that agree are
    counted before they are unfolded into kinds."""
    has = lambda c: c in nh.columns
    age = F.when(F.col("age") != "", F.col("age")).otherwise(F.col("suffix_age")) if has("age") else F.col("suffix_age")
    conflicts = F.array().cast("array<string>")
    if has("age"):
        conflicts = domain.suffix_conflicts(F.col("sex"), F.col("suffix_sex"), dates.age_years(F.col("age")), dates.age_years(F.col("suffix_age")))
    said = {
        "trusted_name": F.col("folder_name") if has("folder_name") else F.lit(""), "header_name": F.col("patient_name"), "raw_name": F.col("patient_name_raw"),
        "birth_date": F.col("birth_date").cast("string"), "sex": F.col("sex"), "institution": F.col("institution_key"),
        "birth_year": dates.birth_year(age, F.col("exam_date")).cast("string"), "source": F.col("source_subject"), "study": F.col("study_uid"),
    }
    rows = nh.where("patient_id <> ''").select("patient_id", *[v.alias(k) for k, v in said.items()], conflicts.alias("conflicts"))
    rows = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))
    pair = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("value"))
    told = F.concat(F.array(pair("file", F.lit("-")), *[pair(k, F.col(k)) for k in said]), F.transform("conflicts", lambda c: pair("conflict", c)))
    rows = rows.select("patient_id", F.explode(told).alias("t"), "n").select("patient_id", "t.*", "n").where("value <> ''")
    return rows.groupBy("patient_id", "kind", "value").agg(F.sum("n").alias("n"))


def add_evidence(*tables: DataFrame) -> DataFrame:
    """The evidence of several scans as one: counts add up in any order and grouping."""
    d = tables[0]
    for t in tables[1:]:
        d = d.unionByName(t)
    return d.groupBy("patient_id", "kind", "value").agg(F.sum("n").alias("n"))


def subject_names(counted: DataFrame, named: DataFrame) -> DataFrame:
    """Further evidence from source folders that are named after a person: named(source, name). The name goes to the ids of the folder
    whose header name fits its initials; to the only id of the folder if that has no header name; else to none."""
    held = counted.where("kind = 'source'").select("patient_id", F.col("value").alias("source")).join(named.where("name <> ''"), "source")
    header = counted.where("kind = 'header_name'").groupBy("patient_id").agg(_commonest(F.lit(True)).alias("header"))
    ids = F.count(F.lit(1)).over(W.partitionBy("source"))
    d = held.withColumn("ids", ids).join(header, "patient_id", "left").withColumn("fits", text.chinese_matches_header(F.col("name"), F.coalesce("header", F.lit(""))))
    d = d.where(F.col("fits") | ((F.col("ids") == 1) & F.col("header").isNull()))
    return d.groupBy("patient_id", F.lit("subject_name").alias("kind"), F.col("name").alias("value")).agg(F.count(F.lit(1)).alias("n"))


def _commonest(when: Column) -> Column:
    """An aggregate over evidence: the value with most files, the least of equals."""
    return F.min(F.when(when, F.struct((-F.col("n")).alias("n"), "value")))["value"]


def profiles_of(counted: DataFrame) -> DataFrame:
    """A row per patient id from its evidence: the name by the most trusted source that has one, commonest values, median birth year,
    institutions, sources, Studies, files, and what the id holds against itself: several birth dates or sexes, ages apart, ages that
    contradict the birth date, headers that contradict their own name."""
    kind = lambda k: F.col("kind") == k
    year = F.when(kind("birth_year"), F.col("value").try_cast("double"))
    g = counted.groupBy("patient_id").agg(
        *[_commonest(kind(k)).alias(f"_{k}") for k in (*NAMES, "raw_name", "birth_date", "sex")],
        *[F.count(F.when(kind(k), 1)).alias(f"n_{k}") for k in ("birth_date", "sex", "study")],
        F.percentile(year, 0.5, F.col("n")).alias("birth_year"),
        (F.max(year) - F.min(year)).alias("_span"),
        *[F.array_sort(F.collect_list(F.when(kind(k), F.col("value")))).alias(c) for k, c in (("institution", "institutions"), ("source", "sources"), ("conflict", "_own"))],
        F.sum(F.when(kind("file"), F.col("n"))).alias("files"),
    )
    name = F.coalesce(*[F.col(f"_{k}") for k in NAMES], F.lit(""))
    birth = F.col("_birth_date").cast("date")
    found = F.array_compact(
        F.array(
            F.when(F.col("_span") > TOLERANCE, "age"),
            F.when(F.abs(F.year(birth) - F.col("birth_year")) > TOLERANCE, "age_vs_birth_date"),
            F.when(F.col("n_birth_date") > 1, "birth_date"),
            F.when(F.col("n_sex") > 1, "sex"),
        )
    )
    key = lambda c: text.name_key(c)
    return g.select(
        "patient_id", name.alias("canonical_name"), key(name).alias("name_key"), F.coalesce("_header_name", F.lit("")).alias("header_name"),
        key(F.coalesce("_header_name", F.lit(""))).alias("header_key"), F.coalesce("_raw_name", F.lit("")).alias("raw_name"), birth.alias("birth_date"),
        F.coalesce("_sex", F.lit("")).alias("sex"), "birth_year", "institutions", "sources", F.col("n_study").alias("studies"), "files",
        F.array_join(F.array_sort(F.array_distinct(F.concat(found, "_own"))), ",").alias("internal_conflicts"),
    )


def profiles(nh: DataFrame) -> DataFrame:
    """A row per patient id of one scan (see ``profiles_of``)."""
    return profiles_of(evidence(nh))


def relation(left: str = "l", right: str = "r") -> Column:
    """struct<relation, evidence, conflicts> of two profiles of one name. What either profile holds against itself counts
    as a conflict of the pair, so an id that several people share is confirmed with none. Only differing birth dates, of the pair or inside
    an id, with sex and institution in agreement, ask for a review; other conflicts stand; two pieces of evidence confirm."""
    a, b = (lambda c: F.col(f"{left}.{c}")), (lambda c: F.col(f"{right}.{c}"))
    births = a("birth_date").isNotNull() & b("birth_date").isNotNull()
    sexes = (a("sex") != "") & (b("sex") != "")
    years = a("birth_year").isNotNull() & b("birth_year").isNotNull()
    near = F.abs(a("birth_year") - b("birth_year")) <= TOLERANCE
    evidence_ = F.array_compact(
        F.array(
            F.when(births & (a("birth_date") == b("birth_date")), "birth_date"),
            F.when(sexes & (a("sex") == b("sex")), "sex"),
            F.when(F.arrays_overlap(a("institutions"), b("institutions")), "institution"),
            F.when(years & near, "age"),
        )
    )
    own = F.filter(F.concat(F.split(a("internal_conflicts"), ","), F.split(b("internal_conflicts"), ",")), lambda c: c != "")
    pair = F.array_compact(
        F.array(
            F.when(births & (a("birth_date") != b("birth_date")), "birth_date"),
            F.when(sexes & (a("sex") != b("sex")), "sex"),
            F.when(years & ~near, "age"),
        )
    )
    conflicts = F.array_sort(F.array_distinct(F.concat(own, pair)))
    review = (conflicts == F.array(F.lit("birth_date"))) & F.array_contains(evidence_, "sex") & F.array_contains(evidence_, "institution")
    name = F.when(review, "review_group").when(F.size(conflicts) > 0, "conflict").when(F.size(evidence_) >= 2, "confirmed").otherwise("possible")
    return F.struct(name.alias("relation"), F.array_join(evidence_, ",").alias("evidence"), F.array_join(conflicts, ",").alias("conflicts"))


#: Profiles of one key that a task pairs with the others at once; larger blocks are split.
BLOCK_ROWS = 2048


def blocked(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Pairs (l, r) of rows with one key, each once, l before r in the order. Every key's rows are dealt to as many shares as its size
    asks for, and each share meets all rows of the key, so that a common name is no single task."""
    size = rows.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("_shares")).where("_shares > 1")
    d = rows.join(size, key, "left").withColumn("_shares", F.coalesce("_shares", F.lit(1)))
    one = d.withColumn("_share", F.pmod(F.xxhash64(order), F.col("_shares").cast("long")).cast("int")).alias("l")
    all_ = d.withColumn("_share", F.explode(F.sequence(F.lit(0), F.col("_shares") - 1))).alias("r")
    return one.join(all_, (F.col(f"l.{key}") == F.col(f"r.{key}")) & (F.col("l._share") == F.col("r._share")) & (F.col(f"l.{order}") < F.col(f"r.{order}")))


def pairs(people: DataFrame) -> DataFrame:
    """left_id, right_id, name_key, basis, relation, evidence, conflicts for each pair of profiles with one canonical name, or else
    with one header name (``basis`` says which): two blocked joins in one, of which the first that finds a pair keeps it."""
    if "internal_conflicts" not in people.columns:  # profiles that tell of none
        people = people.withColumn("internal_conflicts", F.lit(""))
    if "header_key" not in people.columns:
        people = people.withColumn("header_key", F.lit(""))
    keys = F.array(F.struct(F.lit("canonical_name").alias("basis"), F.col("name_key").alias("key")), F.struct(F.lit("header_patient_name").alias("basis"), F.col("header_key").alias("key")))
    facts = ["patient_id", "name_key", "birth_date", "sex", "birth_year", "institutions", "internal_conflicts"]
    rows = people.select(*facts, F.explode(keys).alias("k")).where("k.key <> ''")
    rows = rows.select(*facts, "k.*", F.concat(F.substring("k.basis", 1, 1), F.lit(":"), "k.key").alias("block"))
    both = blocked(rows, "block", "patient_id")
    both = both.where((F.col("l.basis") == "canonical_name") | (F.col("l.name_key") != F.col("r.name_key")) | (F.col("l.name_key") == ""))
    return both.select(F.col("l.patient_id").alias("left_id"), F.col("r.patient_id").alias("right_id"), F.col("l.key").alias("name_key"), F.col("l.basis").alias("basis"), relation().alias("x")).select(
        "left_id", "right_id", "name_key", "basis", "x.*"
    )


class Groups:
    """Merged ids, each group with the groups it has a conflict with: a veto is a look-up. The smaller group and the smaller set of
    conflicts move, so that n ids take n log n moves."""

    def __init__(self) -> None:
        self.group: dict[str, str] = {}
        self.members: dict[str, list[str]] = {}
        self.foes: dict[str, set[str]] = {}
        self.least: dict[str, str] = {}

    def of(self, p: str) -> str:
        if p not in self.group:
            self.group[p], self.members[p], self.foes[p], self.least[p] = p, [p], set(), p
        return self.group[p]

    def conflict(self, a: str, b: str) -> None:
        x, y = self.of(a), self.of(b)
        if x != y:
            self.foes[x].add(y)
            self.foes[y].add(x)

    def apart(self, a: str, b: str) -> bool:
        return self.of(b) in self.foes[self.of(a)]

    def merge(self, a: str, b: str) -> None:
        x, y = self.of(a), self.of(b)
        if x == y:
            return
        if len(self.members[x]) + len(self.foes[x]) < len(self.members[y]) + len(self.foes[y]):
            x, y = y, x
        for p in self.members[y]:
            self.group[p] = x
        self.members[x] += self.members.pop(y)
        for f in self.foes.pop(y):
            self.foes[f].discard(y)
            if f != x:
                self.foes[f].add(x)
                self.foes[x].add(f)
        self.least[x] = min(self.least[x], self.least.pop(y))


def _merge_block(pdf: pd.DataFrame) -> pd.DataFrame:
    """Merges of one block's ids: first those of earlier groups, then in the order of the pairs reviewed groups always,
    and confirmed pairs unless the two groups as they then are hold a conflict."""
    g = Groups()
    rows = list(pdf.sort_values(["left_id", "right_id"])[["left_id", "right_id", "relation"]].itertuples(index=False, name=None))
    for a, b, kind in rows:
        if kind == "conflict":
            g.conflict(a, b)
    for a, b, kind in rows:
        if kind == "prior":
            g.merge(a, b)
    for a, b, kind in rows:
        if kind == "review_group" or (kind == "confirmed" and not g.apart(a, b)):
            g.merge(a, b)
    return pd.DataFrame(sorted((p, g.least[x]) for p, x in g.group.items()), columns=["patient_id", "group_id"])


def groups(people: DataFrame, related: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """patient_id, group_id: the least id of its person. Merges depend on their order, so a block of ids that merges
    could connect is decided in one place. existing(patient_id, group_key) are the groups of earlier runs: their ids are
    one person before any pair is looked at, whatever this run says of them."""
    related = related.select("left_id", "right_id", "relation")
    if existing is not None:
        first = existing.groupBy("group_key").agg(F.min("patient_id").alias("left_id"))
        prior = existing.join(first, "group_key").where("left_id < patient_id").select("left_id", F.col("patient_id").alias("right_id"), F.lit("prior").alias("relation"))
        related = related.union(prior)
    linking = related.where("relation IN ('prior', 'confirmed', 'review_group')")
    blocks = connected_components(linking.select(F.col("left_id").alias("a"), F.col("right_id").alias("b")))
    l, r = blocks.alias("l"), blocks.alias("r")
    inside = related.where("relation <> 'possible'").join(l, F.col("left_id") == F.col("l.node")).join(r, F.col("right_id") == F.col("r.node"))
    inside = inside.where("l.component = r.component").select(F.col("l.component").alias("block"), "left_id", "right_id", "relation")
    merged = inside.groupBy("block").applyInPandas(lambda pdf: _merge_block(pdf), "patient_id string, group_id string")
    return people.select("patient_id", "name_key").join(merged, "patient_id", "left").select("patient_id", "name_key", F.coalesce("group_id", "patient_id").alias("group_id"))


def group_keys(grouped: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """grouped(patient_id, group_id) with group_key: the least key that one of the group's ids has already, else
    ``G`` and six digits from one beyond the highest, in the order of least ids."""
    g = grouped.groupBy("group_id").agg(F.count(F.lit(1)).alias("ids"))
    last = 0
    if existing is not None:
        known = grouped.join(existing, "patient_id").groupBy("group_id").agg(F.min("group_key").alias("known"))
        g = g.join(known, "group_id", "left")
        last = highest(existing, "group_key", "G")
    else:
        g = g.withColumn("known", F.lit(None).cast("string"))
    fresh = numbered(g.where("known IS NULL"), "group_id")
    fresh = fresh.select("group_id", "ids", code("G", F.col("number") + F.lit(last)).alias("group_key"), F.lit(False).alias("old"))
    old = g.where("known IS NOT NULL").select("group_id", "ids", F.col("known").alias("group_key"), F.lit(True).alias("old"))
    return grouped.join(fresh.union(old), "group_id")


def routes(keyed: DataFrame, related: DataFrame) -> DataFrame:
    """patient_id, group_key, folder, match_status: a group that shares its name with another gets its key in the
    folder's name; a reviewed merge outranks a known group, that a confirmed one."""
    names = keyed.select("name_key", "group_id").distinct().groupBy("name_key").agg(F.count(F.lit(1)).alias("groups"))
    reviewed = related.where("relation = 'review_group'")
    reviewed = reviewed.select(F.explode(F.array("left_id", "right_id")).alias("patient_id")).distinct().withColumn("reviewed", F.lit(True))
    d = keyed.join(names, "name_key").join(reviewed, "patient_id", "left")
    status = (
        F.when(F.col("reviewed") & (F.col("ids") > 1), "grouped_needs_review")
        .when(F.col("old") & (F.col("ids") > 1), "auto_merged_historical_group")
        .when(F.col("old"), "existing_mapping")
        .when(F.col("ids") > 1, "auto_confirmed_multi_id")
        .otherwise("new_identity")
    )
    base = F.when(F.col("name_key") == "", "UNKNOWN").otherwise(F.upper("name_key"))
    folder = F.when((F.col("ids") > 1) & (F.col("groups") > 1), F.concat_ws("__", base, "group_key")).when(F.col("ids") > 1, base).otherwise(F.concat_ws("_", "patient_id", base))
    return d.select("patient_id", "group_id", "group_key", folder.alias("folder"), status.alias("match_status"))


def review_rows(related: DataFrame, grouped: DataFrame | None = None, drifts: DataFrame | None = None) -> DataFrame:
    """Pairs that a person must look at, and why. With grouped(patient_id, group_id), confirmed pairs that a conflict of
    their groups kept apart are told as ``mapping_conflict``. drifts(patient_id, drift) are ids that differ from earlier
    runs: a row each, of the id with itself, where the drift isn't empty."""
    status = F.when(F.col("relation") == "review_group", "grouped_needs_review").when(F.col("relation") == "possible", "needs_review").when(F.col("relation") == "conflict", "conflict").otherwise("auto_resolved")
    if grouped is not None:
        side = lambda c: grouped.select(F.col("patient_id").alias(f"{c}_id"), F.col("group_id").alias(f"_{c}"))
        related = related.join(side("left"), "left_id", "left").join(side("right"), "right_id", "left")
        status = F.when((F.col("relation") == "confirmed") & (F.col("_left") != F.col("_right")), "mapping_conflict").otherwise(status)
    rows = related.select("left_id", "right_id", status.alias("status"), F.when(F.col("conflicts") != "", F.col("conflicts")).otherwise(F.col("evidence")).alias("basis"))
    if drifts is None:
        return rows
    drifted = drifts.where("drift <> ''").select(F.col("patient_id").alias("left_id"), F.col("patient_id").alias("right_id"), F.lit("mapping_drift").alias("status"), F.col("drift").alias("basis"))
    return rows.unionByName(drifted)


def dominant_ids(nh: DataFrame) -> DataFrame:
    """source_subject, patient_id: the one with most Studies, then most files; none where two share the first place."""
    n = nh.where("patient_id <> ''").groupBy("source_subject", "patient_id").agg(F.count_distinct("study_uid").alias("studies"), F.count(F.lit(1)).alias("files"))
    order = W.partitionBy("source_subject").orderBy(F.desc("studies"), F.desc("files"))
    first = n.withColumn("rank", F.rank().over(order)).where("rank = 1")
    return first.groupBy("source_subject").agg(F.min("patient_id").alias("patient_id"), F.count(F.lit(1)).alias("n")).where("n = 1").drop("n")


def source_audit(nh: DataFrame, grouped: DataFrame) -> DataFrame:
    """Source folders with several patient ids: how many ids and persons they hold, and what that asks for."""
    d = nh.where("patient_id <> ''").select("source_subject", "patient_id").distinct().join(grouped.select("patient_id", "group_id"), "patient_id")
    g = d.groupBy("source_subject").agg(F.count(F.lit(1)).alias("ids"), F.count_distinct("group_id").alias("persons")).where("ids > 1")
    return g.withColumn("action", F.when(F.col("persons") == 1, "same_person").otherwise("split_by_person"))


def set_profiles(nh: DataFrame, grain: str) -> DataFrame:
    """A row per value of the grain with the sets of what its files say; birth years are those that ages and exam dates give."""
    age = F.when(F.col("age") != "", F.col("age")).otherwise(F.col("suffix_age")) if "age" in nh.columns else F.col("suffix_age")
    year = F.floor(dates.birth_year(age, F.col("exam_date"))).cast("int")
    some = lambda c: F.array_sort(F.collect_set(F.when(F.col(c) != "", F.col(c))))
    return nh.groupBy(grain).agg(
        some("patient_id").alias("patient_ids"), some("name_key").alias("names"), F.array_sort(F.collect_set(F.col("birth_date").cast("string"))).alias("birth_dates"),
        some("sex").alias("sexes"), F.array_sort(F.collect_set(year)).alias("birth_years"), some("institution_key").alias("institutions"), F.count(F.lit(1)).alias("files"),
    )


def subject_gate(nh: DataFrame, subject: str = "patient_id") -> DataFrame:
    """Whether all Studies of a subject are one person: ``conflict`` if a Study has two names, birth dates or sexes or
    two Studies differ in one; ``insufficient`` if a Study lacks a name, or a birth date, sex and birth year, or if two
    Studies share less than two facts (name, birth date, sex, a birth year, an institution); else ``confirmed``.

    Where nothing conflicts, Studies that have a birth date or a sex have the same one, so a subject whose Studies all
    have one needs no pairs. For the others, pairs are formed of what Studies have, not of the Studies."""
    names = ("name_key", "birth_date", "sex")
    some = {c: F.when(F.col(c).cast("string") != "", F.col(c)) for c in names}
    year = F.floor(dates.birth_year(F.col("suffix_age"), F.col("exam_date"))).cast("int")
    s = nh.where(F.col(subject) != "").groupBy(subject, "study_uid").agg(
        *[F.min(some[c]).alias(c) for c in names], *[(F.min(some[c]) != F.max(some[c])).alias(f"_{c}") for c in names],
        F.array_sort(F.collect_set(year)).alias("years"), F.array_sort(F.collect_set(F.when(F.col("institution_key") != "", F.col("institution_key")))).alias("institutions"),
    )
    split = F.coalesce("_name_key", F.lit(False)) | F.coalesce("_birth_date", F.lit(False)) | F.coalesce("_sex", F.lit(False))
    bare = F.col("birth_date").isNull() & F.col("sex").isNull() & (F.size("years") == 0)
    g = s.groupBy(subject).agg(
        F.count(F.lit(1)).alias("studies"),
        *[F.coalesce(F.min(c) != F.max(c), F.lit(False)).alias(f"n_{c}") for c in names],
        F.bool_or(split).alias("split"),
        F.bool_or(bare | F.col("name_key").isNull()).alias("thin"),
        (F.bool_and(F.col("birth_date").isNotNull()) | F.bool_and(F.col("sex").isNotNull())).alias("shared"),
    )
    apart = F.col("n_name_key") | F.col("n_birth_date") | F.col("n_sex") | F.col("split")
    open_ = g.where(~(apart | F.col("thin") | F.col("shared"))).select(subject)
    has = F.struct(F.col("birth_date").isNotNull().alias("birth"), F.col("sex").isNotNull().alias("sex"), "years", "institutions")
    kinds = s.join(open_, subject).select(subject, has.alias("has")).distinct()
    l, r = kinds.alias("l"), kinds.alias("r")
    common_ = (
        (F.col("l.has.birth") & F.col("r.has.birth")) | (F.col("l.has.sex") & F.col("r.has.sex"))
        | F.arrays_overlap("l.has.years", "r.has.years") | F.arrays_overlap("l.has.institutions", "r.has.institutions")
    )
    lone = l.join(r, (F.col(f"l.{subject}") == F.col(f"r.{subject}")) & (F.col("l.has") < F.col("r.has")) & ~common_)
    lone = lone.select(F.col(f"l.{subject}").alias(subject)).distinct().withColumn("lone", F.lit(True))
    conflicts = F.array_compact(F.array(*[F.when(F.col(f"n_{c}"), c) for c in names], F.when(F.col("split"), "within_study")))
    thin = F.col("thin") | F.coalesce("lone", F.lit(False))
    status = F.when(F.size(conflicts) > 0, "conflict").when(thin, "insufficient").otherwise("confirmed")
    return g.join(lone, subject, "left").select(subject, "studies", status.alias("decision"), F.array_join(conflicts, ",").alias("conflicts"))


def package_gate(profiles_: DataFrame, subject: str) -> DataFrame:
    """profiles_(subject, grain, names, birth_dates, sexes): a hard conflict between two of a subject's profiles is
    other names and a demographic conflict, or one name and two; otherwise the subject's number decides."""
    both = blocked(profiles_, subject, "key")
    apart = lambda c: ((F.size(f"l.{c}") > 0) & (F.size(f"r.{c}") > 0) & ~F.arrays_overlap(f"l.{c}", f"r.{c}")).cast("int")
    demographic = apart("birth_dates") + apart("sexes")
    hard = ((apart("names") == 1) & (demographic >= 1)) | ((apart("names") == 0) & (demographic >= 2))
    worst = both.groupBy(F.col(f"l.{subject}").alias(subject)).agg(F.bool_or(hard).alias("hard"), F.bool_or(apart("names") == 1).alias("other_names"))
    all_ = profiles_.groupBy(subject).agg(F.count(F.lit(1)).alias("profiles"))
    d = all_.join(worst, subject, "left")
    status = F.when(F.col("hard"), "different_person_unresolved").when(F.col("other_names"), "screening_default").otherwise("confirmed")
    return d.select(subject, "profiles", status.alias("decision"))


def code_ledger(subjects: DataFrame, ledger: DataFrame) -> DataFrame:
    """subjects(center, screening, natural), ledger(center, screening, number) -> number and whether it is new.

    A subject keeps its number; others continue their center's after the highest, in natural order."""
    d = subjects.join(ledger, ["center", "screening"], "left")
    last = ledger.groupBy("center").agg(F.max("number").alias("last"))
    at = F.row_number().over(W.partitionBy("center", F.col("number").isNull()).orderBy("natural", "screening"))
    d = d.withColumn("at", at).join(last, "center", "left")
    number = F.coalesce("number", F.coalesce("last", F.lit(0)) + F.col("at"))
    return d.select("center", "screening", number.cast("long").alias("number"), F.col("number").isNull().alias("is_new"))


def ledger_faults(ledger: DataFrame) -> DataFrame:
    """Rows that break the one-to-one rule between subjects and numbers of a center; none in a valid ledger."""
    by_subject = F.count(F.lit(1)).over(W.partitionBy("center", "screening"))
    by_number = F.count(F.lit(1)).over(W.partitionBy("center", "number"))
    return ledger.withColumn("n_subject", by_subject).withColumn("n_number", by_number).where("n_subject > 1 OR n_number > 1")
