import random
import re

import numpy as np
import pytest
import xxhash

from studyloom.llm import neardup as N


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(fps, radius=2):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprint(awkward):
    for _, text, *_ in awkward:
        assert N.fingerprint(text or "") == plain_fingerprint(text or "")
    assert N.fingerprint("A b") == plain_fingerprint("a B") != 0


def test_votes_in_parts(monkeypatch):
    text = " ".join(f"w{i * i % 97}" for i in range(1000))
    monkeypatch.setattr(N, "VOTES", 64)
    assert N.fingerprint(text) == plain_fingerprint(text)


def near_cluster(n, seed, bits=6):
    rnd = random.Random(seed)
    base = rnd.getrandbits(64)
    return sorted({base ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, bits))) for _ in range(n)} | {rnd.getrandbits(64) for _ in range(n // 4)})


@pytest.mark.parametrize("queries", [16, 512])
def test_forest_finds_all_links(monkeypatch, queries):
    monkeypatch.setattr(N, "QUERIES", queries)
    fps = near_cluster(300, 1)
    shard = np.array([i % 2 for i in range(len(fps))])
    forest = N.Forest(shard, np.array(fps, dtype=np.uint64))
    found = {(int(a), int(b)) for x, y in forest.links(2) for a, b in zip(x, y, strict=True)}
    want = {(i, j) for j in range(len(fps)) for i in range(j) if shard[i] == shard[j] and (fps[i] ^ fps[j]).bit_count() <= 2}
    assert found == want


@pytest.mark.parametrize("tree", [8, 4096])
def test_groups_equal_brute_force(spark, tree):
    fps = near_cluster(400, 2) + [0, 1, 3]
    signed = [int(np.array(f, dtype=np.uint64).view(np.int64)) for f in fps]
    docs = spark.createDataFrame([(i, f) for i, f in enumerate(signed)] + [(1000, signed[5]), (None, signed[7])], "doc_id long, fp long")
    got = {r.doc_id: r.component_id for r in N.near_duplicates(docs, tree=tree).collect()}
    want = plain_components(fps)
    assert [got[i] for i in range(len(fps))] == want
    assert got[1000] == want[5] and got[None] == want[7]


def test_query_and_stage(spark, documents, awkward):
    folder = documents(awkward)
    got = N.op10_neardup(spark, folder).collect()
    assert len(got) == len(awkward)
    by_id = {r.doc_id: r for r in got}
    assert by_id[0].fingerprint == "0" * 16 and {by_id[i].component_id for i in (0, 1, 2, 12)} == {0}
    assert by_id[5].component_id == by_id[6].component_id == by_id[7].component_id == 5
    docs = spark.read.parquet(f"{folder}/documents.parquet").selectExpr("*", "1 AS fp", "2 AS component_id")
    kept = N.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect())
    assert ids == sorted({r.component_id for r in got} - {None})


def test_empty_table(spark, documents):
    assert N.op10_neardup(spark, documents([])).collect() == []


def jaccard(a, b):
    sets = [{tuple(t.lower().split()[i : i + 5]) for i in range(max(1, len(t.split()) - 4))} for t in (a, b)]
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def edited_copies():
    """Texts of 60 words, copies with a few words changed at one or two places, and a chain of edits."""
    rnd = random.Random(7)
    out = []
    for _ in range(12):
        words = [f"w{rnd.randrange(5000)}" for _ in range(60)]
        out.append(words)
        for k in (1, 2, 3, 6, 12):
            for _ in range(3):
                at = rnd.randrange(60 - k)
                out.append(words[:at] + [f"x{rnd.randrange(5000)}" for _ in range(k)] + words[at + k :])
        for k in range(0, 20, 4):
            words = [*words[:k], f"y{k}", *words[k + 1 :]]
            out.append(words)
    return [" ".join(w) for w in out]


@pytest.mark.parametrize("leads", [2, 0])
def test_stage_keeps_one_of_each_group_of_five_word_shingles(spark, documents, monkeypatch, leads):
    from studyloom.llm import overlap

    monkeypatch.setattr(overlap, "LEADS", leads)
    monkeypatch.setattr(overlap, "PART_PAIRS", 4)
    texts = edited_copies()
    parent = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if parent[i] != parent[j] and jaccard(texts[i], texts[j]) >= 0.8:
                a, b = sorted((parent[i], parent[j]))
                parent = [a if p == b else p for p in parent]
    folder = documents([(i, t, "en", "a", len(t)) for i, t in enumerate(texts)])
    kept = sorted(r.doc_id for r in N.keep_one(spark.read.parquet(f"{folder}/documents.parquet")).collect())
    assert kept == sorted(set(parent))


def test_forest_tells_the_nearest_before(monkeypatch):
    monkeypatch.setattr(N, "QUERIES", 16)
    fps = near_cluster(200, 3, 20)
    shard = [i % 3 for i in range(len(fps))]
    got = N.Forest(np.array(shard), np.array(fps, dtype=np.uint64)).nearest(24)
    for b, to in enumerate(got.tolist()):
        near = [((fps[a] ^ fps[b]).bit_count(), a) for a in range(b) if shard[a] == shard[b] and (fps[a] ^ fps[b]).bit_count() <= 24]
        assert to == (min(near)[1] if near else -1)


def test_stage_links_by_trees_of_five_word_fingerprints(spark, documents, monkeypatch):
    """Without leaders and rarest shingles the BK-trees alone join near copies, and what they link is decided by the exact overlap."""
    from pyspark.sql import functions as F

    from studyloom.llm import overlap

    monkeypatch.setattr(overlap, "LEADS", 0)
    monkeypatch.setattr(overlap, "_by_rarest", lambda nodes, sets: nodes.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0))
    texts = edited_copies()
    parent = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if parent[i] != parent[j] and jaccard(texts[i], texts[j]) >= 0.8:
                a, b = sorted((parent[i], parent[j]))
                parent = [a if p == b else p for p in parent]
    folder = documents([(i, t, "en", "a", len(t)) for i, t in enumerate(texts)])
    rows = overlap.sketched(spark.read.parquet(f"{folder}/documents.parquet"))
    found = {r.doc_id: r for r in overlap.with_components(rows).collect()}
    assert all(len({parent[i] for i in found if found[i].component == c}) == 1 for c in {r.component for r in found.values()})
    joined, want = len(texts) - len({r.component for r in found.values()}), len(texts) - len(set(parent))
    assert joined >= 0.9 * want


def test_stage_chooses_rows_and_not_ids(spark, documents):
    a, b = (" ".join(f"{p}{i}" for i in range(30)) for p in "ab")
    rows = [(1, a, "en", "s", 1), (2, a, "en", "s", 1), (2, b, "en", "s", 1), (None, a, "en", "s", 1), (None, "no id", "en", "s", 1), (None, "No ID", "en", "s", 2)]
    kept = N.keep_one(spark.read.parquet(f"{documents(rows)}/documents.parquet")).collect()
    assert {(r.doc_id, r.text) for r in kept} == {(1, a), (2, b), (None, "no id")} and len(kept) == 3


def test_parities_rule_out_no_sets_alike():
    from studyloom.llm import overlap

    random = np.random.default_rng(7)
    for size in (1, 5, 146, 3000):
        for gone in (0, size // 20, size // 9, size // 4):
            x = np.unique(random.integers(0, 1 << 64, size, dtype=np.uint64))
            y = np.unique(np.r_[x[gone:], random.integers(0, 1 << 64, gone, dtype=np.uint64)])
            bits = int(np.bitwise_count((overlap.parities(x) ^ overlap.parities(y)).view(np.uint64)).sum())
            assert bits <= len(np.setxor1d(x, y))
            assert not overlap.alike(x, y) or bits * 9 <= len(x) + len(y)


def test_folded_parities_count_modulo_fewer_bins(spark):
    from pyspark.sql import functions as F

    from studyloom.llm import overlap

    rnd = np.random.default_rng(9)
    hashes = rnd.integers(0, 1 << 64, 300, dtype=np.uint64)
    d = spark.createDataFrame([(overlap.parities(hashes).tolist(),)], "p array<long>")
    got = np.array(d.select(*overlap._folded(F.col("p"))).first(), dtype=np.int64)
    bins = overlap.PARITIES // overlap.FOLDED
    want = np.packbits((np.bincount((hashes % np.uint64(bins)).astype(np.int64), minlength=bins) & 1).astype(np.uint8)).view(np.int64)
    assert got.tolist() == want.tolist()


def test_rows_meet_once_by_shingle_and_large_components_not_at_all(spark, monkeypatch):
    import itertools

    from pyspark.sql import functions as F

    from studyloom.llm import overlap

    monkeypatch.setattr(overlap, "PART_MEETINGS", 50)
    draw = random.Random(5)
    rows = sorted({(draw.randrange(6), n, draw.choice([1, 1, 1, 2, n])) for n in range(100, 160) for _ in range(3)})
    rows = list({(h, n): (h, n, label) for h, n, label in rows}.values())  # a node has one label to a shingle
    rows += [(9, n, 1) for n in range(1000, 1400)] + [(9, 2000, 7), (9, 2001, 8)] + [(10, n, 3) for n in range(1000, 1300)]
    rare = spark.createDataFrame(rows, "h long, node long, label long").cache()
    got = sorted((r.h, *sorted((r.a, r.b))) for r in overlap._met(rare).select(F.col("l.h").alias("h"), F.col("l.node").alias("a"), F.col("r.node").alias("b")).collect())
    want = sorted((x[0], *sorted((x[1], y[1]))) for x, y in itertools.combinations(rows, 2) if x[0] == y[0] and x[2] != y[2])
    assert got == want
    # what is looked at, before any condition: the two others meet the 402 rows, and the component of 300 meets nobody
    one, all_ = (d.groupBy("h", "part").count() for d in overlap._sides(rare))
    looked = {r.h: r.n for r in one.alias("l").join(all_.alias("r"), ["h", "part"]).groupBy("h").agg(F.sum(F.col("l.count") * F.col("r.count")).alias("n")).collect()}
    assert looked[9] == 2 * 402 and 10 not in looked
