"""Identity across subjects and over time: rerouting of misfiled profiles, drift from history, stable codes, plans.

Profiles here are sets: (subject, key, ids, names, birth_dates, sexes). Candidates meet by an equal name or id only.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from studyloom.functions import text
from studyloom.operators.components import connected_components
from studyloom.operators.identity import TOLERANCE, blocked
from studyloom.operators.order import code, highest, numbered, previous
from studyloom.storage import staged

#: Sets of a profile that demographic comparison looks at, and what evidence calls them.
DEMOGRAPHICS = {"birth_dates": "birth_date", "sexes": "sex", "birth_years": "birth_year"}


def _meets(a: Column, b: Column) -> Column:
    return F.arrays_overlap(a, b)


def _apart(a: Column, b: Column) -> Column:
    return (F.size(a) > 0) & (F.size(b) > 0) & ~F.arrays_overlap(a, b)


def _years_meet(a: Column, b: Column) -> Column:
    """Whether any two birth years differ by a year at most."""
    return F.exists(a, lambda x: F.exists(b, lambda y: F.abs(x - y) <= 1))


def _with_years(profiles: DataFrame) -> DataFrame:
    return profiles if "birth_years" in profiles.columns else profiles.withColumn("birth_years", F.array().cast("array<int>"))


def demographic(left: str = "l", right: str = "r") -> tuple[dict[str, Column], Column]:
    """Whether each of DEMOGRAPHICS agrees, and in how many two profiles that both have values contradict each other."""
    side = lambda c: (F.col(f"{left}.{c}"), F.col(f"{right}.{c}"))
    meets = {c: (_years_meet if c == "birth_years" else _meets)(*side(c)) for c in DEMOGRAPHICS}
    both = lambda c: (F.size(side(c)[0]) > 0) & (F.size(side(c)[1]) > 0)
    return meets, sum(((both(c) & ~m).cast("int") for c, m in meets.items()), F.lit(0))


def strong_matches(profiles: DataFrame) -> DataFrame:
    """(subject, key, to_subject, evidence) for profiles of other subjects that share a name, have no demographic
    conflict, and share an id or two demographic facts. A common name is dealt to several tasks."""
    named = _with_years(profiles).withColumn("name", F.explode("names")).withColumn("at", F.concat_ws("\x01", "subject", "key"))
    both = blocked(named, "name", "at")
    side = lambda c: (F.col(f"l.{c}"), F.col(f"r.{c}"))
    meets, conflicts = demographic()
    ids = _meets(*side("ids"))
    facts = sum((m.cast("int") for m in meets.values()), F.lit(0))
    evidence = F.array_join(F.array_compact(F.array(F.lit("name"), F.when(ids, "id"), *[F.when(m, DEMOGRAPHICS[c]) for c, m in meets.items()])), "+")
    found = both.where((F.col("l.subject") != F.col("r.subject")) & (conflicts == 0) & (ids | (facts >= 2)))
    one = lambda a, b: F.struct(F.col(f"{a}.subject").alias("subject"), F.col(f"{a}.key").alias("key"), F.col(f"{b}.subject").alias("to_subject"), evidence.alias("evidence"))
    return found.select(F.explode(F.array(one("l", "r"), one("r", "l"))).alias("m")).select("m.*").distinct()


def peers(profiles: DataFrame) -> DataFrame:
    """The conflict graph among each subject's profiles: (subject, key, peer, hard, mismatch, weak), both ways. hard: other names and a
    demographic conflict, or one name and two; mismatch: other names; weak: not hard, and a name or two facts are not shared."""
    both = blocked(_with_years(profiles), "subject", "key")
    meets, conflicts = demographic()
    names = (F.col("l.names"), F.col("r.names"))
    differ, same = _apart(*names), _meets(*names)
    hard = (differ & (conflicts >= 1)) | (same & (conflicts >= 2))
    facts = sum((m.cast("int") for m in meets.values()), F.lit(0))
    seen = both.select(F.col("l.subject").alias("subject"), F.col("l.key").alias("a"), F.col("r.key").alias("b"), hard.alias("hard"), differ.alias("mismatch"), (~hard & (~same | (facts < 2))).alias("weak"))
    ends = F.explode(F.array(F.struct(F.col("a").alias("key"), F.col("b").alias("peer")), F.struct(F.col("b").alias("key"), F.col("a").alias("peer")))).alias("e")
    return seen.select("subject", ends, "hard", "mismatch", "weak").select("subject", "e.*", "hard", "mismatch", "weak")


def _inner_conflicts() -> Column:
    """In how many demographic facts a profile contradicts itself."""
    several = lambda c: (F.size(c) > 1).cast("int")
    return several("birth_dates") + several("sexes") + F.coalesce((F.array_max("birth_years") - F.array_min("birth_years") > 1).cast("int"), F.lit(0))


def reroutes(profiles: DataFrame) -> DataFrame:
    """(subject, key, target, action) of the profiles that a run has to place; with a column ``is_new``, of those only.

    A profile that a peer of its subject contradicts, or whose name none of a peer's is, and that strongly matches exactly one other
    subject, is rerouted there, unless no profile would be left to stand for the subject: then none is. After that, a profile that
    contradicts itself in two facts, or hard conflicts with a peer that stays, is held (``different_person_unresolved``, no target). The
    others follow their subject, with a warning where evidence is thin or another subject resembles them."""
    p = _with_years(profiles)
    p = p if "is_new" in p.columns else p.withColumn("is_new", F.lit(True))
    edges = staged(peers(p), "subject-peers")
    near = edges.groupBy("subject", "key").agg(F.bool_or("hard").alias("hard"), F.bool_or("mismatch").alias("mismatch"))
    other = strong_matches(p).groupBy("subject", "key").agg(F.count_distinct("to_subject").alias("n"), F.min("to_subject").alias("to_subject"))
    thin = (F.size("ids") == 0) | (F.size("names") != 1) | (_inner_conflicts() == 1)
    d = p.select("subject", "key", "is_new", thin.alias("thin"), (_inner_conflicts() >= 2).alias("inner"))
    d = d.join(near, ["subject", "key"], "left").join(other, ["subject", "key"], "left")
    no = lambda c: F.coalesce(F.col(c), F.lit(False))
    d = d.withColumn("leaves", F.col("is_new") & F.coalesce(F.col("n") == 1, F.lit(False)) & (no("hard") | no("mismatch")))
    weak = edges.groupBy("subject").agg(F.bool_or("weak").alias("weak"))
    all_ = d.groupBy("subject").agg(F.bool_and("leaves").alias("none_left"), F.bool_or(no("hard") | F.col("inner")).alias("conflict"), F.bool_or("thin").alias("any_thin"))
    d = staged(d.join(all_.join(weak, "subject", "left"), "subject").withColumn("leaves", F.col("leaves") & ~F.col("none_left")), "subject-plan")
    stay = d.where("NOT leaves").select("subject", F.col("key").alias("peer"))
    facing = edges.where("hard").join(stay, ["subject", "peer"]).select("subject", "key").distinct().withColumn("facing", F.lit(True))
    d = d.where("is_new").join(facing, ["subject", "key"], "left")
    held = ~F.col("leaves") & (F.col("inner") | no("facing"))
    warned = (~F.col("conflict") & (F.col("any_thin") | no("weak"))) | (F.col("n").isNotNull() & ~no("hard"))
    action = F.when(F.col("leaves"), "rerouted").when(held, "different_person_unresolved").when(warned, "screening_default_warning").otherwise("confirmed_same")
    target = F.when(F.col("leaves"), F.col("to_subject")).when(~held, F.col("subject"))
    return d.select("subject", "key", target.alias("target"), action.alias("action"))


CHINESE = r"[\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}]"


def canonical_name(known: Column, seen: Column, seen_header: Column) -> Column:
    """Which name an id goes on with. What is known stays, unless it is none, or the new one is Chinese and it is not, or it is a Chinese name
    that the header's doesn't fit and the new one is not Chinese."""
    chinese = lambda c: c.rlike(CHINESE)
    none = (F.coalesce(known, F.lit("")) == "") | (known == "Unknown")
    misfit = chinese(known) & ~text.chinese_matches_header(known, F.coalesce(seen_header, F.lit(""))) & ~F.coalesce(chinese(seen), F.lit(False))
    replaced = none | (chinese(seen) & ~chinese(known)) | misfit
    return F.when(seen.isNull(), known).when(replaced, seen).otherwise(known)


def merge_history(mapped: DataFrame, observed: DataFrame) -> DataFrame:
    """Both (patient_id, name_key, birth_date, sex, birth_year) -> one row per id: history wins, gaps are filled, and
    ``drift`` tells where a known value was seen to differ. If both have canonical_name, header_name and header_key as well, so has the
    result: names drift only where the header's names differ too, and a better name replaces the known one (``canonical_name``)."""
    m, o = mapped.alias("m"), observed.alias("o")
    d = m.join(o, F.col("m.patient_id") == F.col("o.patient_id"), "full_outer")
    side = lambda c: (F.col(f"m.{c}"), F.col(f"o.{c}"))
    some = lambda c: F.when(c.cast("string") != "", c)
    first = lambda c: F.coalesce(some(side(c)[0]), some(side(c)[1]))
    differ = lambda c: some(side(c)[0]) != some(side(c)[1])
    whole = all({"canonical_name", "header_name", "header_key"} <= set(x.columns) for x in (mapped, observed))
    name, more = differ("name_key"), []
    if whole:
        same_header = some(side("header_key")[0]) == side("header_key")[1]
        name = name & ~F.coalesce(same_header, F.lit(False)) & (side("canonical_name")[1] != "Unknown")
        kept = F.when(side("patient_id")[0].isNull(), side("canonical_name")[1]).otherwise(canonical_name(*side("canonical_name"), side("header_name")[1]))
        latest = lambda c: F.coalesce(some(side(c)[1]), some(side(c)[0]), F.lit("")).alias(c)
        more = [kept.alias("canonical_name"), latest("header_name"), latest("header_key")]
    drift = F.array_compact(
        F.array(F.when(differ("birth_date"), "birth_date"), F.when(differ("sex"), "sex"), F.when(F.abs(side("birth_year")[0] - side("birth_year")[1]) > TOLERANCE, "age"), F.when(name, "name"))
    )
    key = text.name_key(kept) if whole else F.coalesce(first("name_key"), F.lit(""))
    return d.select(
        F.coalesce(*side("patient_id")).alias("patient_id"), key.alias("name_key"), first("birth_date").alias("birth_date"),
        F.coalesce(first("sex"), F.lit("")).alias("sex"), F.coalesce(*side("birth_year")).alias("birth_year"), F.array_join(drift, ",").alias("drift"), *more,
    )


class Known:
    """Profiles that have a code already, by name and by id. A look-up meets only those that share one of them and whose birth date and sex
    don't contradict, and of these each set of facts once, however many profiles have it."""

    def __init__(self) -> None:
        self.both: dict[tuple, set] = {}
        self.by: dict[tuple, dict[tuple, dict[tuple, dict[object, set]]]] = {}

    def add(self, row, code: object) -> None:
        if row.name_key and row.patient_id:
            self.both.setdefault((row.name_key, row.patient_id), set()).add(code)
        facts = (row.birth_year, row.age, row.study_date)
        for key, other in ((("n", row.name_key), row.patient_id), (("i", row.patient_id), row.name_key)):
            if key[1]:
                bucket = self.by.setdefault(key, {}).setdefault((row.birth_date, row.sex), {})
                bucket.setdefault(facts, {}).setdefault(code, set()).add(other)

    def related(self, row) -> tuple[set, set, set]:
        """Codes whose profiles are the same by name and id; that facts confirm; that may be the same."""
        same = self.both.get((row.name_key, row.patient_id), set()) if row.name_key and row.patient_id else set()
        confirmed, possible = set(), set()
        for key, other in ((("n", row.name_key), row.patient_id), (("i", row.patient_id), row.name_key)):
            for bucket, agree in self._compatible(self.by.get(key, {}) if key[1] else {}, row):
                for facts, codes in bucket.items():
                    by_age = _ages(row, *facts)
                    if by_age is None:
                        continue
                    found = confirmed if agree + by_age >= 2 else possible
                    found.update(c for c, others in codes.items() if c not in found and (not other or others != {other}))
        return set(same), confirmed, possible

    @staticmethod
    def _compatible(buckets: dict, row):
        """Buckets without a contradiction, and in how many facts each agrees."""
        if not row.birth_date:
            keys = [k for k in buckets if not (row.sex and k[1] and k[1] != row.sex)]
        else:
            keys = [k for b in (row.birth_date, None) for x in ((row.sex, None) if row.sex else {x for _, x in buckets}) if (k := (b, x)) in buckets]
        for birth, sex in dict.fromkeys(keys):
            yield buckets[birth, sex], int(bool(birth) and birth == row.birth_date) + int(bool(sex) and sex == row.sex)


def _ages(row, year, age, study_date) -> int | None:
    """1 if ages agree, 0 if there is nothing to compare, None if they contradict: by estimated birth years, or where one lacks, by
    equal ages at one Study date."""
    if row.birth_year is not None and year is not None:
        return 1 if abs(row.birth_year - year) <= TOLERANCE else None
    if row.age and age and row.study_date == study_date:
        return 1 if row.age == age else None
    return 0


def _assign_block(pdf: pd.DataFrame) -> pd.DataFrame:
    """Profiles of one block in order, after those of earlier runs: each keeps the code it has, else takes the only one that
    confirms it, else opens a new one."""
    pdf = pdf.astype(object).where(pdf.notna(), None)
    for c in ("birth_date", "sex", "age"):
        pdf[c] = pdf[c].where(pdf[c] != "", None)
    known, kept, out = Known(), {}, []
    for row in pdf[pdf.code.notna()].sort_values(["code", "folder"]).itertuples(index=False):
        known.add(row, row.code)
        kept.setdefault((row.folder, row.name_key, row.patient_id), row.code)
    for row in pdf[pdf.code.isna()].sort_values(["folder", "name_key", "patient_id"]).itertuples(index=False):
        triple = (row.folder, row.name_key, row.patient_id)
        if triple in kept:
            code, status = kept[triple], "existing_mapping"
        else:
            same, confirmed, possible = known.related(row)
            if len(same | confirmed) == 1:
                code, status = (same | confirmed).pop(), "demographic_confirmed" if confirmed else "exact_confirmed"
            else:
                code, status = triple, "needs_review" if same or confirmed or possible else "new_identity"
            known.add(row, code)
            kept[triple] = code
        out.append((*triple, *((None, None, None, code) if isinstance(code, str) else (*code, None)), status))
    return pd.DataFrame(out, columns=["folder", "name_key", "patient_id", "f", "n", "i", "known", "status"])


def assign_codes(profiles: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """profiles(folder, patient_id, name_key, birth_date string, sex, birth_year, and if known age, study_date), one row for each name
    and id of a folder -> folder, name_key, patient_id, code, status.

    Which code a profile takes depends on those before it (by folder, name and id) that share its name or id, however indirectly: such a
    block is decided in one place, with an index of what has a code by then. existing has the same columns and code, of earlier runs: a
    folder's name and id keep their code. New codes go on after the highest, numbered in the order of the profiles that opened them."""
    key, facts = ["folder", "name_key", "patient_id"], ["birth_date", "sex", "birth_year", "age", "study_date"]

    def whole(d: DataFrame, code: Column) -> DataFrame:
        for c in ("age", "study_date"):
            d = d if c in d.columns else d.withColumn(c, F.lit(None).cast("string"))
        return d.select(*[F.coalesce(c, F.lit("")).alias(c) for c in key], *facts, code.alias("code"))

    d = whole(profiles, F.lit(None).cast("string"))
    if existing is not None:
        d = d.union(whole(existing, F.col("code")))
    d = d.withColumn("row", F.concat_ws("\x01", F.lit("f"), *key))
    keys = F.array_compact(F.array(F.when(F.col("patient_id") != "", F.concat(F.lit("i:"), "patient_id")), F.when(F.col("name_key") != "", F.concat(F.lit("n:"), "name_key"))))
    edges = d.select(F.col("row").alias("a"), F.explode(keys).alias("b"))
    blocks = connected_components(edges).where("node LIKE 'f\x01%'").select(F.col("node").alias("row"), F.col("component").alias("block"))
    d = d.join(blocks, "row", "left").withColumn("block", F.coalesce("block", "row")).drop("row")
    schema = "folder string, name_key string, patient_id string, f string, n string, i string, known string, status string"
    found = staged(d.groupBy("block").applyInPandas(lambda pdf: _assign_block(pdf), schema), "assigned")
    by = F.struct("f", "n", "i").alias("by")
    opened = numbered(found.where("f IS NOT NULL").select(by).distinct(), "by")
    opened = opened.select("by", code("E", F.col("number") + F.lit(highest(existing, "code", "E"))).alias("code"))
    return found.withColumn("by", by).join(opened, "by", "left").select(*key, F.coalesce("known", "code").alias("code"), "status")


def subject_key(subject: Column, patient_id: Column, issuer: Column, name: Column, birth: Column, source: Column) -> Column:
    """What a file's person is known by: the folder of its subject, else the id with its issuer, else name and birth date,
    else where the file is from. The words before the bar are fixed values."""
    up = lambda c: F.upper(text.clean(c))
    key = lambda kind, *cs: F.concat_ws("|", F.lit(kind), *cs)
    some = lambda c: F.coalesce(c, F.lit("")) != ""
    return (
        F.when(some(subject), key("SOURCE_SUBJECT", up(subject))).when(some(patient_id), key("PID", up(issuer), up(patient_id)))
        .when(some(name) | some(birth), key("DEMOGRAPHIC", up(name), text.clean(birth))).otherwise(key("SOURCE", up(source)))
    )


def anonymous_ids(files: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """files(path, key, legacy) -> key, anonymous_id, in the order of paths: a key that existing(key, anonymous_id) knows
    keeps its id; a new one takes the id that its first file's legacy key has by then, from the file before it with that
    legacy key or from existing; else it opens a new one, after the highest.

    So each key follows at most one other, and ids are those of the roots of these trees. Rows of one legacy key, a shared id such as 0 for
    instance, spread over ranges of paths. Repeated rows count once; of one path, the lesser key is first."""
    first = previous(files.select("path", "key", "legacy").distinct(), "legacy", ["path", "key"], "key", "parent")
    first = first.groupBy("key").agg(F.min(F.struct("path", "legacy", "parent")).alias("f")).select("key", "f.*")
    known = files.sparkSession.createDataFrame([], "key string, anonymous_id string") if existing is None else existing.select("key", "anonymous_id")
    own = known.withColumnRenamed("anonymous_id", "own")
    by_legacy = known.select(F.col("key").alias("legacy"), F.col("anonymous_id").alias("inherited"))
    first = first.join(own, "key", "left").join(by_legacy, "legacy", "left")
    # a key of earlier runs follows none; a key without a file before it takes what its legacy key had
    first = first.withColumn("parent", F.when(F.col("own").isNull(), F.col("parent")))
    first = staged(first.withColumn("known", F.coalesce("own", F.when(F.col("parent").isNull(), F.col("inherited")))), "anonymous-keys")
    trees = connected_components(first.where("parent IS NOT NULL").select(F.col("key").alias("a"), F.col("parent").alias("b")))
    placed = first.join(trees, F.col("key") == F.col("node"), "left").withColumn("tree", F.coalesce("component", "key")).select("key", "tree", "path", "parent", "known")
    roots = staged(placed.where("parent IS NULL").select("tree", "path", "known"), "anonymous-roots")
    opened = numbered(roots.where("known IS NULL").select("tree", F.struct("path", "tree").alias("at")), "at")
    opened = opened.select("tree", code("ANON", F.col("number") + F.lit(highest(existing, "anonymous_id", "ANON"))).alias("anonymous_id"))
    ids = opened.union(roots.where("known IS NOT NULL").select("tree", "known"))
    return placed.join(ids, "tree").select("key", "anonymous_id")


def ids_per_code(mapping: DataFrame) -> DataFrame:
    """mapping(code, patient_id) -> code, patient_ids: all of a code's ids, sorted and joined."""
    return mapping.where("patient_id <> ''").groupBy("code").agg(F.array_join(F.array_sort(F.collect_set("patient_id")), "|").alias("patient_ids"))


def ledger_conflicts(ledger: DataFrame, current: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """(key, attribute) where a ledger row and the current data both have a value and differ. Must be empty."""
    l, c = ledger.alias("l"), current.alias("c")
    d = l.join(c, F.col(f"l.{key}") == F.col(f"c.{key}"))
    bad = [F.when((F.col(f"l.{a}") != "") & (F.col(f"c.{a}") != "") & (F.col(f"l.{a}") != F.col(f"c.{a}")), a) for a in attributes]
    return d.select(F.col(f"l.{key}").alias(key), F.explode(F.array_compact(F.array(*bad))).alias("attribute"))


def route_files(nh: DataFrame, routes: DataFrame) -> DataFrame:
    """Files with their person's folder; those without a route go to the review folder."""
    d = nh.join(routes.select("patient_id", "folder"), "patient_id", "left")
    return d.withColumn("folder", F.coalesce("folder", F.lit("_identity_review")))


def audit(routes: DataFrame, results: DataFrame, key: str = "relative_path") -> DataFrame:
    """Every planned file with what became of it."""
    return routes.join(results.select(key, "status"), key, "left").withColumn("status", F.coalesce("status", F.lit("not_run")))


def audit_place(rows: DataFrame) -> DataFrame:
    """Sort columns of an audit report: numeric codes in their order, others after all."""
    return rows.withColumn("code_order", F.coalesce(F.col("code").try_cast("long"), F.lit(10**12)))


def rename_plan(folders: DataFrame, overrides: DataFrame) -> tuple[DataFrame, DataFrame]:
    """folders(folder, code, date, subject), overrides(folder, date, subject) -> (folder, new_name), faults(folder,
    reason). Overrides win. A plan with any fault is not to be carried out at all."""
    o = overrides.select("folder", F.col("date").alias("_date"), F.col("subject").alias("_subject"))
    d = folders.join(o, "folder", "left")
    d = d.select("folder", "code", F.coalesce("_date", "date").alias("date"), F.coalesce("_subject", "subject").alias("subject"))
    name = F.concat_ws("_", "subject", F.coalesce("date", F.lit("")), "code")
    same = F.count(F.lit(1)).over(W.partitionBy("new_name"))
    d = d.withColumn("new_name", name).withColumn("same", same)
    why = F.array_compact(F.array(F.when(F.col("date").isNull() | ~F.coalesce("date", F.lit("")).rlike("^[0-9]{8}$"), "date"), F.when(F.col("subject") == "", "subject"), F.when(F.col("same") > 1, "target_taken")))
    return d.select("folder", "new_name"), d.select("folder", F.explode(why).alias("reason"))


def unused(parameters: DataFrame, used: DataFrame, key: str) -> DataFrame:
    """Confirmations that no Study needed. Must be empty, or the run stops."""
    return parameters.join(used.select(key).distinct(), key, "left_anti")


def merge_profiles(*collections: DataFrame) -> DataFrame:
    """Profiles of several scans as one per key: sets united, files added up."""
    d = collections[0]
    for c in collections[1:]:
        d = d.unionByName(c)
    sets = [F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))).alias(c) for c in ("ids", "names", *DEMOGRAPHICS) if c in d.columns]
    return d.groupBy("subject", "key").agg(*sets, F.sum("files").alias("files"))


def natural_order(rows: DataFrame, column: str) -> DataFrame:
    return rows.withColumn("natural", text.natural_key(F.col(column)))
