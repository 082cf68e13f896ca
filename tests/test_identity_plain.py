"""Identity against plain versions that look at every pair, over the queries' own data and over random blocks."""

import random
import time
from collections import defaultdict
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from studyloom.operators import identity as I
from studyloom.operators import routing as R
from studyloom.plans import identity as PI
from studyloom.plans import routing as PR

SF = "/root/testdata/sf0.001"


def compare(a, b):
    """basis, relation, evidence, conflicts of two profiles; None without a common name."""
    if a.name_key and a.name_key == b.name_key:
        basis = "canonical_name"
    elif a.header_key and a.header_key == b.header_key:
        basis = "header_patient_name"
    else:
        return None
    conflicts = {c for p in (a, b) for c in p.internal_conflicts.split(",") if c}
    evidence = []
    for kind, x, y in (("birth_date", a.birth_date, b.birth_date), ("sex", a.sex, b.sex)):
        if x and y:
            evidence.append(kind) if x == y else conflicts.add(kind)
    if set(a.institutions) & set(b.institutions):
        evidence.append("institution")
    if a.birth_year is not None and b.birth_year is not None:
        evidence.append("age") if abs(a.birth_year - b.birth_year) <= 1.25 else conflicts.add("age")
    if conflicts == {"birth_date"} and {"sex", "institution"} <= set(evidence):
        relation = "review_group"
    else:
        relation = "conflict" if conflicts else "confirmed" if len(evidence) >= 2 else "possible"
    return basis, relation, ",".join(evidence), ",".join(sorted(conflicts))


def merged(ids, pairs, prior=()):
    """group of each id, one pair after the other; every veto looks at all pairs of both groups."""
    group = {p: {p} for p in ids}
    bad = {frozenset(p) for p, kind in pairs.items() if kind == "conflict"}

    def unite(a, b):
        if group[a] is not group[b]:
            both = group[a] | group[b]
            for p in both:
                group[p] = both

    for a, b in prior:
        unite(a, b)
    for (a, b), kind in sorted(pairs.items()):
        if kind == "review_group" or (kind == "confirmed" and not any(frozenset((x, y)) in bad for x in group[a] for y in group[b])):
            unite(a, b)
    return {p: min(g) for p, g in group.items()}


@pytest.fixture(scope="module")
def data(spark):
    people = I.profiles(PI._nh(spark, SF)).collect()
    pairs = {}
    for i, a in enumerate(sorted(people, key=lambda p: p.patient_id)):
        for b in sorted(people, key=lambda p: p.patient_id)[i + 1 :]:
            if found := compare(a, b):
                pairs[a.patient_id, b.patient_id] = found
    groups = merged([p.patient_id for p in people], {k: v[1] for k, v in pairs.items()})
    return SimpleNamespace(people=people, pairs=pairs, groups=groups)


def test_pairs_and_groups(spark, data):
    assert {v[0] for v in data.pairs.values()} == {"canonical_name", "header_patient_name"}
    assert {c for v in data.pairs.values() for c in v[3].split(",")} >= {"age", "age_vs_birth_date", "birth_date", "suffix_age"}
    got = {(r.left_id, r.right_id): (r.basis, r.relation, r.evidence, r.conflicts) for r in PI.e01_identity_pairs(spark, SF).collect()}
    assert got == data.pairs
    assert {r.patient_id: r.group_id for r in PI.e07_identity_groups(spark, SF).collect()} == data.groups
    people, related, _ = PI._groups(spark, SF)
    old = [(p.patient_id, f"G{int(p.patient_id[1:]) % 7:06d}") for p in data.people if int(p.patient_id[1:]) % 5 == 0]
    first = {k: min(p for p, key in old if key == k) for _, k in old}
    want = merged([p.patient_id for p in data.people], {k: v[1] for k, v in data.pairs.items()}, [(first[k], p) for p, k in old])
    assert {r.patient_id: r.group_id for r in I.groups(people, related, spark.createDataFrame(old, "patient_id string, group_key string")).collect()} == want


def test_routes(spark, data):
    members = defaultdict(list)
    for p, g in data.groups.items():
        members[g].append(p)
    key = {g: f"G{i + 1:06d}" for i, g in enumerate(sorted(members))}
    name = {p.patient_id: p.name_key for p in data.people}
    groups_of_name = defaultdict(set)
    for p, g in data.groups.items():
        groups_of_name[name[p]].add(g)
    reviewed = {p for pair, v in data.pairs.items() if v[1] == "review_group" for p in pair}
    want = set()
    for p, g in data.groups.items():
        several, base = len(members[g]) > 1, (name[p] or "UNKNOWN").upper()
        folder = (base + "__" + key[g] if len(groups_of_name[name[p]]) > 1 else base) if several else f"{p}_{base}"
        status = ("grouped_needs_review" if p in reviewed else "auto_confirmed_multi_id") if several else "new_identity"
        want.add((p, g, key[g], folder, status))
    assert set(map(tuple, PI.e10_identity_routes(spark, SF).collect())) == want


def test_source_audit(spark, data):
    held = defaultdict(set)
    for r in PI._nh(spark, SF).where("patient_id <> ''").select("source_subject", "patient_id").distinct().collect():
        held[r.source_subject].add(r.patient_id)
    want = set()
    for source, ids in held.items():
        persons = len({data.groups[p] for p in ids})
        if len(ids) > 1:
            want.add((source, len(ids), persons, "same_person" if persons == 1 else "split_by_person"))
    assert set(map(tuple, PI.e13_source_audit(spark, SF).collect())) == want


FACTS = ("birth_date", "sex", "birth_year", "age", "study_date")


def alike(a, b):
    name, ident = bool(a["name_key"]) and a["name_key"] == b["name_key"], bool(a["patient_id"]) and a["patient_id"] == b["patient_id"]
    if name and ident:
        return "same"
    if not (name or ident):
        return None
    agree = differ = 0
    for c in ("birth_date", "sex"):
        if a[c] and b[c]:
            agree, differ = agree + (a[c] == b[c]), differ + (a[c] != b[c])
    if a["birth_year"] is not None and b["birth_year"] is not None:
        near = abs(a["birth_year"] - b["birth_year"]) <= 1.25
        agree, differ = agree + near, differ + (not near)
    elif a["age"] and b["age"] and a["study_date"] == b["study_date"]:
        agree, differ = agree + (a["age"] == b["age"]), differ + (a["age"] != b["age"])
    return None if differ else "confirmed" if agree >= 2 else "possible"


def coded(rows, existing=()):
    """(folder, name, id) -> code, status, one after the other, each compared with all that have a code."""
    known = [dict(r) for r in existing]
    last = max([int(r["code"][1:]) for r in known], default=0)
    key = lambda r: (r["folder"], r["name_key"], r["patient_id"])
    out = {}
    for r in sorted(rows, key=key):
        kept = sorted((k["code"], k["folder"]) for k in known if key(k) == key(r))
        if kept:
            out[key(r)] = (kept[0][0], "existing_mapping")
            continue
        found = defaultdict(set)
        for k in known:
            found[alike(r, k)].add(k["code"])
        sure = found["same"] | found["confirmed"]
        if len(sure) == 1:
            code, status = sure.pop(), "demographic_confirmed" if found["confirmed"] else "exact_confirmed"
        else:
            last += 1
            code, status = f"E{last:06d}", "needs_review" if sure or found["possible"] else "new_identity"
        known.append({**r, "code": code})
        out[key(r)] = (code, status)
    return out


SCHEMA = "folder string, patient_id string, name_key string, birth_date string, sex string, birth_year double, age string, study_date string"


def assigned(spark, rows, existing=None):
    columns = [c.split()[0] for c in SCHEMA.split(", ")]
    d = spark.createDataFrame([tuple(r[c] for c in columns) for r in rows], SCHEMA)
    e = None if existing is None else spark.createDataFrame([(*[r[c] for c in columns], r["code"]) for r in existing], SCHEMA + ", code string")
    return {(r.folder, r.name_key, r.patient_id): (r.code, r.status) for r in R.assign_codes(d, e).collect()}


@pytest.mark.parametrize("seed", range(3))
def test_codes_of_random_profiles(spark, seed):
    rnd = random.Random(seed)
    pick = lambda *xs: rnd.choice(xs)

    def profile(folder):
        return {
            "folder": folder, "patient_id": pick("", *[f"i{k}" for k in range(25)]), "name_key": pick("", *[f"n{k}" for k in range(12)]), "birth_date": pick(None, "19500101", "19600101"),
            "sex": pick(None, "", "M", "F"), "birth_year": pick(None, 1950.0, 1951.0, 1960.0), "age": pick(None, "", "050Y", "060Y"), "study_date": pick(None, "20240101", "20240202"),
        }

    rows = list({(r["folder"], r["name_key"], r["patient_id"]): r for r in (profile(f"f{rnd.randrange(40):02d}") for _ in range(150))}.values())
    existing = [{**profile(f"f{k % 9:02d}"), "code": f"E{k % 8 + 3:06d}"} for k in range(25)] + [{**r, "code": "E000005"} for r in rows[:10]] if seed else []
    got, want = assigned(spark, rows, existing or None), coded(rows, existing)
    assert {k: s for k, (_, s) in got.items()} == {k: s for k, (_, s) in want.items()}
    assert got == want and len({s for _, s in got.values()}) == 5 - (not existing)


def test_codes_of_the_query(spark):
    rows = [r.asDict() | {"age": None, "study_date": None} for r in PR._folders(spark, SF).collect()]
    got = {(r.folder, r.name_key, r.patient_id): (r.code, r.status) for r in PR.e14_assigned_codes(spark, SF).collect()}
    earlier = [{**r, "code": got[r["folder"], r["name_key"], r["patient_id"]][0]} for r in rows if got[r["folder"], r["name_key"], r["patient_id"]][1] == "existing_mapping"]
    assert earlier and got == coded(rows, earlier)
    assert max(pd.Series([k[0] for k in got]).value_counts()) > 2  # several profiles in one folder


def test_two_persons_in_a_folder_get_two_codes(spark):
    rows = [{"folder": "a", "patient_id": i, "name_key": n, **dict.fromkeys(FACTS)} for i, n in (("i", "n"), ("i2", "n2"))]
    assert {c for c, _ in assigned(spark, rows).values()} == {"E000001", "E000002"}


def test_equal_age_on_one_study_date_counts(spark):
    base = {"name_key": "n", "birth_date": None, "sex": "M", "birth_year": None, "study_date": "20240101"}
    rows = [base | {"folder": "a", "patient_id": "1", "age": "X"}, base | {"folder": "b", "patient_id": "2", "age": "X"}, base | {"folder": "c", "patient_id": "3", "age": "Y"}]
    got = assigned(spark, rows)
    assert got["b", "n", "2"] == ("E000001", "demographic_confirmed") and got["c", "n", "3"] == ("E000002", "new_identity")


@pytest.mark.parametrize("seed", range(20))
def test_merges_of_random_blocks(seed):
    rnd = random.Random(seed)
    ids = [f"p{i:02d}" for i in range(rnd.choice((4, 12, 40)))]
    kinds = ("confirmed", "confirmed", "conflict", "review_group", "possible")
    pairs = {(a, b): rnd.choice(kinds) for i, a in enumerate(ids) for b in ids[i + 1 :] if rnd.random() < 0.2}
    prior = [tuple(sorted(rnd.sample(ids, 2))) for _ in range(rnd.randrange(3))]
    pdf = pd.DataFrame([(*k, v) for k, v in pairs.items()] + [(*p, "prior") for p in prior], columns=["left_id", "right_id", "relation"])
    want = merged(ids, pairs, prior)
    got = dict(I._merge_block(pdf).itertuples(index=False, name=None))
    assert got == {p: want[p] for p in got} and all(want[p] == p for p in ids if p not in got)


def test_a_block_of_fifty_thousand_ids():
    n = 50_000
    rows = [(f"p{i:06d}", f"p{i + 1:06d}", "confirmed") for i in range(n - 1)] + [(f"p{i:06d}", f"p{i + n // 2:06d}", "conflict") for i in range(0, n // 2, 5)]
    pdf = pd.DataFrame(rows, columns=["left_id", "right_id", "relation"])
    began = time.perf_counter()
    out = I._merge_block(pdf)
    assert len(out) == n and out.group_id.nunique() > 1
    assert time.perf_counter() - began < 3  # a second where nothing else runs


def test_ages_of_one_id(spark):
    """Ages that differ, and a birth date that they contradict, are conflicts of the id itself."""
    rows = [("p", "A B", "A B", d, a, "M", "x", "s", "u", "20200101", "", "") for d, a in (("1990-01-01", "005Y"), ("1990-01-01", "070Y"))]
    cols = "patient_id patient_name patient_name_raw birth_date age sex institution_key source_subject study_uid exam_date suffix_age suffix_sex".split()
    nh = spark.createDataFrame(rows, cols).withColumns({"birth_date": F.to_date("birth_date"), "exam_date": F.to_date("exam_date", "yyyyMMdd")})
    assert I.profiles(nh).first().internal_conflicts == "age,age_vs_birth_date"


def test_source_folders_named_after_a_person(spark):
    rows = [("a", "header_name", "CHEN SU", 3), ("a", "source", "S1", 3), ("b", "header_name", "LI WEI", 2), ("b", "source", "S1", 2), ("c", "source", "S2", 1), ("d", "source", "S3", 1), ("e", "source", "S3", 1)]
    counted = spark.createDataFrame(rows, "patient_id string, kind string, value string, n long")
    named = spark.createDataFrame([("S1", "陈苏"), ("S2", "王明"), ("S3", "王明")], "source string, name string")
    found = I.subject_names(counted, named)
    assert {(r.patient_id, r.value) for r in found.collect()} == {("a", "陈苏"), ("c", "王明")}
    people = {r.patient_id: r.canonical_name for r in I.profiles_of(I.add_evidence(counted, found)).collect()}
    assert people == {"a": "陈苏", "b": "LI WEI", "c": "王明", "d": "", "e": ""}


def test_evidence_adds_up_in_any_order(spark):
    nh = PI._nh(spark, SF)
    parts = [I.evidence(nh.where(f"file_size % 4 = {k}")) for k in range(4)]
    whole = {tuple(r) for r in I.evidence(nh).collect()}
    assert {tuple(r) for r in I.add_evidence(parts[2], I.add_evidence(parts[3], parts[0]), parts[1]).collect()} == whole


def test_split_blocks_pair_the_same(spark, monkeypatch):
    want = sorted(map(tuple, PI.e01_identity_pairs(spark, SF).collect()))
    monkeypatch.setattr(I, "BLOCK_ROWS", 2)
    assert sorted(map(tuple, PI.e01_identity_pairs(spark, SF).collect())) == want
