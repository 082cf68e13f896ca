import hashlib

import corpus_pipeline
from studyloom.llm import bpe, mixing, neardup, pii

CLEAN = "an ordinary sentence about maps and rivers number"


def folder_of(documents):
    rows = []
    for i in range(160):
        text = " ".join(f"{CLEAN.split()[(i * 7 + k * k) % 8]}{(i * 31 + k) % 50}" for k in range(40))
        if i % 6 == 0:
            text += " you idiot moron scum worthless trash"
        if i % 10 == 3:
            text += " reach me at jane (at) example [dot] com"
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
    rows += [(200, rows[1][1], "en", "s1", 0), (201, rows[1][1].upper(), "en", "s2", 0), (202, None, None, None, None), (203, "", "en", "s0", 0), rows[1]]
    folder = documents(rows)
    documents([(i, 1, int(i % 6 == 0)) for i in range(160)], "doc_id long, quality int, toxic int", "labels")
    return folder, rows


def test_stages_in_turn(spark, documents):
    folder, rows = folder_of(documents)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        docs.write.mode("overwrite").parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        seen[name] = docs.collect()
        if name != "tokens":
            assert docs.columns == columns
    texts = {r[0]: r[1] for r in rows}
    clean = {i for i in texts if not (i < 160 and i % 6 == 0)}
    assert {r.doc_id for r in seen["toxicity"]} == clean and len(seen["toxicity"]) == len(clean) + 1
    kept = sorted(r.doc_id for r in seen["near duplicates"])
    assert len(set(kept)) == len(kept) and 1 in kept and 200 not in kept and 201 not in kept and 203 not in kept
    shingles = {i: set(neardup.shingle_hashes(texts[i] or "", 5).tolist()) for i in clean}
    alike = lambda x, y: len(x & y) * 5 >= len(x | y) * 4
    for i in clean:  # the stage's rule: who goes has a near copy, and of the kept no two are near copies
        assert i in kept or any(alike(shingles[i], shingles[j]) for j in clean if j != i)
    assert not any(alike(shingles[i], shingles[j]) for i in kept for j in kept if i < j)
    masked = {r.doc_id: r.text for r in seen["personal data"]}
    for i in kept:
        assert masked[i] == pii._mask(texts[i], [dict(zip(("kind", "start", "end", "base"), s, strict=True)) for s in pii.find(texts[i] or "")])
    assert all("<EMAIL>" in masked[i] for i in kept if i < 160 and i % 10 == 3)
    sizes = spark.createDataFrame([(r.doc_id, r.source, len((r.text or "").split())) for r in seen["personal data"]], "doc_id long, source string, size long")
    want = sorted((r.doc_id, r.copies) for r in mixing.mix(sizes).collect() if r.copies)
    got = [r.doc_id for r in seen["mixing"]]
    assert sorted((i, got.count(i)) for i in set(got)) == want
    library = bpe.coder(*bpe.production()).core
    for r in seen["tokens"]:
        assert r.ids == library.encode_ordinary(masked[r.doc_id] or "") and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256((masked[r.doc_id] or "").encode()).hexdigest()
    key = lambda r: (r.doc_id, r.n_tokens)
    assert sorted(corpus_pipeline.run(spark, folder).collect(), key=key) == sorted(seen["tokens"], key=key)


def test_empty_table(spark, documents):
    folder = documents([])
    documents([], "doc_id long, quality int, toxic int", "labels")
    assert corpus_pipeline.run(spark, folder).collect() == []


def test_labels_of_one_kind_drop_nothing(spark, documents):
    folder = documents([(i, f"some text {i} idiot", "en", "s", 0) for i in range(10)])
    documents([(i, 1, 1) for i in range(10)], "doc_id long, quality int, toxic int", "labels")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert corpus_pipeline.drop_toxic(spark, docs, folder).count() == 10
