from studyloom.operators import files
from studyloom.operators import routing as R

SETS = "subject string, key string, ids array<string>, names array<string>, birth_dates array<string>, sexes array<string>"


def test_reroutes_keep_an_anchor(spark):
    rows = [
        ("A", "a1", ["1"], ["li"], ["1950"], ["M"]), ("A", "a2", ["2"], ["wang"], ["1960"], ["F"]),  # a2 belongs to B
        ("B", "b1", ["9"], ["wang"], ["1960"], ["F"]),
        ("C", "c1", ["3"], ["zhao"], ["1970"], ["M"]), ("C", "c2", ["4"], ["qian"], ["1980"], ["M"]),  # both belong elsewhere
        ("D", "d1", ["5"], ["zhao"], ["1970"], ["M"]), ("E", "e1", ["6"], ["qian"], ["1980"], ["M"]),
    ]
    got = {r.key: (r.target, r.action) for r in R.reroutes(spark.createDataFrame(rows, SETS)).collect()}
    assert got["a1"] == ("A", "confirmed_same") and got["a2"] == ("B", "rerouted") and got["b1"] == ("B", "screening_default_warning")
    # nobody would be left to stand for C, so both stay and hold each other
    assert got["c1"] == got["c2"] == (None, "different_person_unresolved")


def _placed(rows):
    """The same, one subject and one pair after the other."""
    facts = ("birth_dates", "sexes", "birth_years")

    def compared(a, b):
        agree = differ = 0
        for c in facts:
            if a[c] and b[c]:
                same = any(abs(x - y) <= 1 for x in a[c] for y in b[c]) if c == "birth_years" else bool(set(a[c]) & set(b[c]))
                agree, differ = agree + same, differ + (not same)
        return agree, differ, bool(set(a["names"]) & set(b["names"])), bool(a["names"] and b["names"] and not set(a["names"]) & set(b["names"]))

    out = {}
    for subject in {r["subject"] for r in rows}:
        own = [r for r in rows if r["subject"] == subject]
        hard, mismatch, doubt = {r["key"]: set() for r in own}, {r["key"]: set() for r in own}, False
        inner = {r["key"]: sum((len(set(r["birth_dates"])) > 1, len(set(r["sexes"])) > 1, bool(r["birth_years"]) and max(r["birth_years"]) - min(r["birth_years"]) > 1)) for r in own}
        for a in own:
            doubt |= not a["ids"] or len(a["names"]) != 1 or inner[a["key"]] == 1
            for b in own:
                if a is b:
                    continue
                agree, differ, same, other = compared(a, b)
                if (other and differ) or (same and differ >= 2):
                    hard[a["key"]].add(b["key"])
                elif not same or agree < 2:
                    doubt = True
                if other:
                    mismatch[a["key"]].add(b["key"])
        conflict = any(hard.values()) or any(v >= 2 for v in inner.values())
        found = {}
        for a in own:
            found[a["key"]] = set()
            for b in rows:
                agree, differ, same, _ = compared(a, b)
                if b["subject"] != subject and same and not differ and (set(a["ids"]) & set(b["ids"]) or agree >= 2):
                    found[a["key"]].add(b["subject"])
        go = {k: next(iter(t)) for k, t in found.items() if len(t) == 1 and (hard[k] or mismatch[k]) and next(r for r in own if r["key"] == k)["is_new"]}
        if len(go) == len(own):
            go = {}
        for r in own:
            k = r["key"]
            if not r["is_new"]:
                continue
            if k in go:
                out[subject, k] = (go[k], "rerouted")
            elif inner[k] >= 2 or hard[k] - set(go):
                out[subject, k] = (None, "different_person_unresolved")
            elif (not conflict and doubt) or (found[k] and not hard[k]):
                out[subject, k] = (subject, "screening_default_warning")
            else:
                out[subject, k] = (subject, "confirmed_same")
    return out


def test_random_profiles_are_placed_as_one_by_one(spark):
    import random

    seen = set()
    for seed in range(5):
        rnd = random.Random(seed)
        some = lambda n, *xs: rnd.sample(xs, min(len(xs), rnd.choice(n)))  # noqa: E731, B023
        rows = [
            {"subject": f"S{rnd.randrange(12):02d}", "key": f"k{i:03d}", "ids": some((0, 1, 1), *[f"i{j}" for j in range(30)]), "names": some((0, 1, 1, 1, 2), *"abcde"), "birth_dates": some((0, 1, 1, 2), "d1", "d2"),
             "sexes": some((0, 1, 1), "M", "F"), "birth_years": some((0, 1, 1, 2), 1950, 1951, 1960), "is_new": rnd.random() < 0.8}
            for i in range(40)
        ]
        columns = list(rows[0])
        d = spark.createDataFrame([tuple(r[c] for c in columns) for r in rows], SETS + ", birth_years array<int>, is_new boolean")
        got = {(r.subject, r.key): (r.target, r.action) for r in R.reroutes(d).collect()}
        assert got == _placed(rows)
        seen |= {a for _, a in got.values()}
    assert seen == {"rerouted", "different_person_unresolved", "screening_default_warning", "confirmed_same"}


def test_codes_follow_confirmed_folders(spark):
    rows = [
        ("f1", "1", "li", "1950", "M", None), ("f2", "1", "li", None, "", None), ("f3", "2", "li", "1950", "M", None), ("f4", "3", "li", "1951", "M", None), ("f5", "4", "li", None, "", None), ("f6", "", "", None, "", None),
    ]
    d = spark.createDataFrame(rows, "folder string, patient_id string, name_key string, birth_date string, sex string, birth_year double")
    got = {r.folder: (r.code, r.status) for r in R.assign_codes(d).collect()}
    assert got["f1"] == ("E000001", "new_identity") and got["f2"] == ("E000001", "exact_confirmed") and got["f3"] == ("E000001", "demographic_confirmed")
    assert got["f4"][1] == "needs_review" and got["f5"][1] == "needs_review" and got["f6"][1] == "new_identity"
    assert len({got[f][0] for f in ("f1", "f4", "f5", "f6")}) == 4


def test_rename_plan(spark):
    f = spark.createDataFrame([("a", "001", "20240101", "S"), ("b", "001", "20240101", "S"), ("c", "002", None, "S")], "folder string, code string, date string, subject string")
    o = spark.createDataFrame([("b", "20240102", None)], "folder string, date string, subject string")
    plan, faults = R.rename_plan(f, o)
    assert {r.folder: r.new_name for r in plan.collect()}["b"] == "S_20240102_001"
    assert [(r.folder, r.reason) for r in faults.collect()] == [("c", "date")]


def test_publish_status(spark):
    v = spark.createDataFrame([("t1", "s", ""), ("t2", "s", ""), ("t3", "s", ""), ("t4", "s", "changed")], "target string, sha string, problems string")
    e = spark.createDataFrame([("t1", "s"), ("t2", "z")], "target string, sha string")
    got = {r.target: r.status for r in files.publish_status(v, e, execute=True).collect()}
    assert got == {"t1": "duplicate_same", "t2": "conflict", "t3": "written", "t4": "verification_failed"}
    assert {r.status for r in files.publish_status(v, e, execute=False).collect()} == {"duplicate_same", "conflict", "planned", "verification_failed"}


def test_unused_confirmations(spark):
    d = spark.createDataFrame([("s1",), ("s2",)], "study_uid string")
    assert [r.study_uid for r in R.unused(d, d.where("study_uid = 's1'"), "study_uid").collect()] == ["s2"]


FOLDER = "folder string, patient_id string, name_key string, birth_date string, sex string, birth_year double"


def test_codes_of_earlier_runs_are_kept(spark):
    old = spark.createDataFrame([("f1", "1", "li", "1950", "M", None, "E000007"), ("x", "8", "wu", "1960", "F", None, "e000009"), ("y", "9", "wu", "1960", "F", None, "E000003")], f"{FOLDER}, code string")
    rows = [
        ("f1", "1", "li", None, "", None), ("f2", "2", "li", "1950", "M", None), ("f3", "3", "li", "1951", "M", None), ("f4", "4", "wu", "1960", "F", None), ("a", "", "", None, "", None),
        ("f5", "3", "li", None, "", None),
    ]
    got = {r.folder: (r.code, r.status) for r in R.assign_codes(spark.createDataFrame(rows, FOLDER), old).collect()}
    assert got["f1"] == ("E000007", "existing_mapping") and got["f2"] == ("E000007", "demographic_confirmed")
    assert got["a"] == ("E000010", "new_identity") and got["f3"] == ("E000011", "new_identity")  # differs from li in the birth date
    assert got["f4"] == ("E000012", "needs_review")  # two codes confirm it
    assert got["f5"] == ("E000011", "exact_confirmed")
    again = old.where("false")
    assert R.assign_codes(spark.createDataFrame([], FOLDER), again).count() == 0


def _ids_one_by_one(rows, existing):
    ids, last = dict(existing), max([int(v[4:]) for v in dict(existing).values()], default=0)
    for _, key, legacy in sorted(set(rows), key=lambda r: (r[0], r[1])):
        if key not in ids:
            if legacy not in ids:
                last += 1
                ids[legacy] = f"ANON{last:06d}"
            ids[key] = ids[legacy]
        ids[legacy] = ids[key]
    return {k: ids[k] for _, k, _ in rows}


def test_anonymous_ids_follow_the_order_of_files(spark):
    import random

    for seed in range(4):
        rnd = random.Random(seed)
        rows = [(f"p{rnd.randrange(400):03d}", "", f"L{rnd.randrange(12)}") for _ in range(60)]
        rows = list({p: (p, f"S{rnd.randrange(15)}", legacy) for p, _, legacy in rows}.values())
        existing = [("S3", "ANON000004"), ("L2", "ANON000002")] if seed % 2 else []
        known = spark.createDataFrame(existing, "key string, anonymous_id string") if existing else None
        got = {r.key: r.anonymous_id for r in R.anonymous_ids(spark.createDataFrame(rows + rows[:5], "path string, key string, legacy string"), known).collect()}
        assert got == _ids_one_by_one(rows, existing)
    assert R.anonymous_ids(spark.createDataFrame([], "path string, key string, legacy string")).count() == 0


def test_history_takes_a_better_name(spark):
    schema = "patient_id string, canonical_name string, name_key string, header_name string, header_key string, birth_date string, sex string, birth_year double"
    row = lambda i, name, header: (i, name, name.lower().replace(" ", ""), header, header.lower().replace(" ", ""), None, "M", None)
    old = [row("1", "LI WEI", "LI WEI"), row("2", "陈苏", "CHEN SU"), row("3", "陈苏", "CHEN SU"), row("4", "Unknown", ""), row("5", "WANG MING", "WANG MING"), row("6", "ONLY OLD", "ONLY OLD")]
    new = [row("1", "李伟", "LI WEI"), row("2", "CHEN S", "CHEN S"), row("3", "WU GANG", "WU GANG"), row("4", "ZHAO", "ZHAO"), row("5", "WANG M", "WANG M"), row("7", "NEW", "NEW")]
    got = {r.patient_id: (r.canonical_name, r.drift) for r in R.merge_history(spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)).collect()}
    assert got["1"] == ("李伟", "")  # Chinese for Latin, and the header's name is the same
    assert got["2"] == ("陈苏", "name")  # fits the initials
    assert got["3"] == ("WU GANG", "name")  # doesn't
    assert got["4"] == ("ZHAO", "name") and got["5"] == ("WANG MING", "name")
    assert got["6"] == ("ONLY OLD", "") and got["7"] == ("NEW", "")


def test_the_row_before_in_a_group_of_many_ranges(spark):
    import random

    from studyloom.operators.order import previous

    rnd = random.Random(2)
    rows = [(rnd.choice(("hot", "hot", "hot", "a", "b", "z")), i, f"v{i}") for i in rnd.sample(range(1000), 300)]
    d = spark.createDataFrame(rows, "g string, o int, v string").repartition(7)
    spark.conf.set("spark.sql.shuffle.partitions", 9)
    try:
        got = {(r.g, r.o): r.before for r in previous(d, "g", ["o"], "v", "before").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    want, last = {}, {}
    for g, o, v in sorted(rows):
        want[g, o], last[g] = last.get(g), v
    assert got == want
