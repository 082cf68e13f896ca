"""Operators that learn: toxicity, language identification, language model."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from studyloom.llm import langid, lm, toxicity

WORDS = {
    "en": "the of and to in that is was for with they this from have were which there their would about".split(),
    "de": "der die und das ist nicht ein ich sie mit den auf sich des dem eine auch werden wurde durch".split(),
}


def corpus(n=240, toxic=()):
    rnd = random.Random(5)
    rows = []
    for i in range(n):
        lang = ("en", "de")[i % 2]
        words = [rnd.choice(WORDS[lang]) for _ in range(rnd.randint(20, 60))]
        if i in toxic:
            words[5:5] = ["you", "zorkhead", "idiot"]
        rows.append((i, " ".join(words), lang, "a", 0))
    return rows


def test_toxicity(spark, documents):
    toxic = set(range(0, 240, 5))
    folder = documents(corpus(toxic=toxic))
    documents([(i, 1, int(i in toxic)) for i in range(240)] + [(3, 1, None), (None, 1, 1), (5, 1, 1)], "doc_id long, quality int, toxic int", "labels")
    got = toxicity.op6_toxicity(spark, folder).collect()
    assert len(got) == 240
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.predicted == int(r.doc_id in toxic)
    docs = spark.read.parquet(f"{folder}/documents.parquet").selectExpr("*", "1 AS features", "2 AS prediction", "3 AS score_", "4 AS label", "5 AS probability")
    kept = toxicity.keep_clean(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(range(240)) - toxic


def test_toxicity_features():
    f = dict(zip(toxicity.NAMES, toxicity.features("YOU are an 1d1ot and i d i o t!! Idiot", {"idiot": 2.0}), strict=True))
    assert f["strongest"] == 2.0 and f["obfuscated"] > 0 and f["exclamations"] > 0 and f["shouted"] > 0
    for text in ("you 1d1ot here", "you !diot here", "you i.d.i.o.t here", "you idiiiiot here", "you IDIOT here"):
        assert toxicity.features(text, {"idiot": 2.0})[0] > 0, text
    assert toxicity.features("you are a fine person, 3 times", {"idiot": 2.0})[0] == 0
    assert toxicity.features("", {"idiot": 2.0}) == [0.0] * len(toxicity.NAMES)


def test_toxicity_batches_of_one_label_and_without_words(spark):
    rows = spark.createDataFrame([("you zorkhead", 1.0)] * 9 + [("123 !!", 1.0), ("", 0.0)] + [("the maps", 0.0)] * 9, "text string, label double")
    want = {"zorkhead", "you"} | set(toxicity.INSULTS)
    for parts in (1, 12, 211):  # with 211, most batches hold one label or nothing
        assert want <= set(toxicity.learn_lexicon(rows.repartition(parts)))
    assert set(toxicity.learn_lexicon(rows.where("text IN ('123 !!', '')"))) == set(toxicity.INSULTS)


def test_toxicity_awkward_rows_and_clashing_columns(spark, documents, awkward):
    toxic = set(range(0, 240, 5))
    rows = corpus(toxic=toxic) + [(1000 + r[0] if r[0] is not None else None, *r[1:]) for r in awkward]
    folder = documents(rows)
    documents([(i, 1, int(i in toxic)) for i in range(240)], "doc_id long, quality int, toxic int", "labels")
    got = toxicity.op6_toxicity(spark, folder).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 1005}) == 1 and sum(r.doc_id == 1005 for r in got) == 3
    by_text = {r.doc_id: r.score for r in got}
    assert by_text[1000] == by_text[1001] == by_text[1002]  # null, empty and blank texts
    docs = spark.read.parquet(f"{folder}/documents.parquet").selectExpr("*", "doc_id AS score", "text AS doc", "7 AS toxic", "8 AS label", "9 AS fold", "doc_id AS _toxicity_raw")
    kept = toxicity.keep_clean(docs, spark.read.parquet(f"{folder}/labels.parquet")).collect()
    assert len(kept) == len(rows) - len(toxic)
    assert all(r.score == r.doc_id == r._toxicity_raw and r.doc == r.text and (r.toxic, r.label, r.fold) == (7, 8, 9) for r in kept)
    assert toxicity.keep_clean(docs.limit(0), spark.read.parquet(f"{folder}/labels.parquet")).collect() == []


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (2, 1, 0)], [(1, 1, 1)]])
def test_toxicity_without_both_labels(spark, documents, awkward, labels):
    folder = documents(awkward)
    documents(labels, "doc_id long, quality int, toxic int", "labels")
    got = toxicity.op6_toxicity(spark, folder).collect()
    assert len(got) == len(awkward) and all(0 <= r.score <= 1 for r in got)


def test_langid(spark, documents, awkward):
    rows = corpus() + [(1000 + i, *r[1:]) for i, r in enumerate(awkward[:14])]
    got = {r.doc_id: r for r in langid.op7_langid(spark, documents(rows)).collect()}
    assert len(got) == len(rows)
    held = [i for i in range(240) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert held and all(got[i].held_out for i in held)
    assert all(got[i].lang_pred == ("en", "de")[i % 2] and got[i].score > 0.5 for i in range(240))
    assert [got[1000 + i].lang_pred for i in (0, 1, 2, 12, 13)] == ["und"] * 5
    assert all(r.lang_pred in ("en", "de", "und") and 0 <= r.score <= 1 for r in got.values())


def test_langid_blocks_and_forgetting(spark, monkeypatch):
    docs = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate([("abab abba cab", "x"), ("bca acb", "x"), ("zz zy", "y")])], "doc_id long, text string, lang string")
    models = langid.learn(docs)
    texts = ["abba cab zz", "zy", "", "new words here", "123"]
    want = langid.Scorer(models).entropies(texts)
    assert want[2] is None and want[4] is None and want[0][0] < want[0][1] and want[1][1] < want[1][0]
    monkeypatch.setattr(langid, "SCORED", 1)
    monkeypatch.setattr(langid, "CACHE", 2)
    scorer = langid.Scorer(models)
    for text, w in zip(texts, want, strict=True):
        got = scorer.entropies([text])[0]
        assert (got is None) == (w is None) and (w is None or abs(got - w).max() < 1e-9)


def plain_entropies(docs, texts):
    """Interpolated Kneser-Ney over dictionaries, a model per language, contexts within a word."""
    letters, order = re.compile(r"[^\W\d_]+"), langid.ORDER
    langs = sorted({lang for _, lang in docs})
    models = {}
    for lang in langs:
        counts = {order: Counter()}
        for text, of in docs:
            for word in letters.findall(text.lower()) if of == lang else ():
                padded = "\x02" * (order - 1) + word + "\x03"
                counts[order].update(padded[i : i + order] for i in range(len(word) + 1))
        for o in range(order - 1, 0, -1):
            counts[o] = Counter(g[1:] for g in counts[o + 1])
        models[lang] = {}
        for o, c in counts.items():
            n1, n2 = (sum(x == k for x in c.values()) for k in (1, 2))
            d = min(n1 / (n1 + 2 * n2) if n1 else 0.5, 0.95)
            total, kinds = Counter(), Counter()
            for g, x in c.items():
                total[g[:-1]] += x
                kinds[g[:-1]] += 1
            models[lang][o] = c, d, total, kinds
    unseen = 1 / (len(set().union(*[m[1][0] for m in models.values()])) + 1)

    def p(m, gram):
        if not gram:
            return unseen
        c, d, total, kinds = m[len(gram)]
        lower, t = p(m, gram[1:]), total[gram[:-1]]
        return max(c[gram] - d, 0) / t + d * kinds[gram[:-1]] / t * lower if t else lower

    out = []
    for text in texts:
        words = ["\x02" * (order - 1) + w + "\x03" for w in letters.findall(text.lower())]
        grams = [w[i : i + order] for w in words for i in range(len(w) - order + 1)]
        out.append([-sum(math.log(p(models[lang], g)) for g in grams) / len(grams) for lang in langs])
    return out


@pytest.mark.parametrize("file_rows", [1 << 20, 8])
def test_langid_equals_plain_models(spark, monkeypatch, file_rows):
    """All grams count, however many files they fill."""
    monkeypatch.setattr(langid, "FILE_ROWS", file_rows)
    rows = [(i, text, lang) for i, text, lang, *_ in corpus(40)] + [(90, "zażółć gęślą jaźń, żółw", "pl"), (91, "zażółć gęślą jaźń, żółw", "pl"), (92, None, "pl"), (93, "x", None)]
    models = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert models.langs == ["de", "en", "pl"] and (len(models.files) > 20) == (file_rows == 8)
    texts = ["the maps of rivers", "nicht ein zug", "żółta jaźń", "qqq", "x"]
    want = plain_entropies([(t, g) for _, t, g in rows if t and g], texts)
    got = langid.Scorer(models).entropies(texts)
    assert all(abs(a - b).max() < 1e-4 for a, b in zip(got, want, strict=True))


def test_langid_calibrates_on_all_rows(spark, documents):
    """Sharpness and limits are those of every row learned from, beyond any bound on their number."""
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choice(WORDS["en" if i % 2 else "de"]) for _ in range(3)), "en" if i % 2 else "de") for i in range(2200)]
    # the last ids are junk in one language: rare words that no small sample holds
    rows += [(None, "".join(rnd.choice("qxzvjkw") for _ in range(12)), "de") for i in range(30)] + [(5000, "123", "en"), (5001, None, "de"), (5002, "der und", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    models = langid.learn(docs.repartition(7))
    known = [(t, g) for _, t, g in rows if t and g and t != "123"]
    found = langid.Scorer(models).entropies([t for t, _ in known])
    own = [[e[k] for e, (_, g) in zip(found, known, strict=True) if g == lang] for k, lang in enumerate(models.langs)]
    assert np.allclose(models.limits, [np.quantile(x, langid.KEPT) * 1.1 for x in own], rtol=1e-9)
    gaps = np.array([e - e[models.langs.index(g)] for e, (_, g) in zip(found, known, strict=True)])
    assert models.sharpness == min(langid.SHARP, key=lambda s: np.log(np.exp(np.minimum(-gaps * s, 50)).sum(axis=1)).sum())
    # the query takes the same rows, but those held out
    folder = documents([(i, t, g, "a", 0) for i, t, g in rows])
    learned = [r for r in rows if zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 4 != 2]
    models = langid.learn(spark.createDataFrame(learned, "doc_id long, text string, lang string"))
    want = {r.text: r.p for r in docs.select("text", langid.identify(docs.text, models).alias("p")).collect()}
    texts = {i: t for i, t, _ in rows}
    got = langid.op7_langid(spark, folder).collect()
    assert len(got) == len(rows)
    assert all((r.lang_pred, r.rejected) == want[texts[r.doc_id]][::2] and abs(r.score - want[texts[r.doc_id]].score) < 1e-9 for r in got if r.doc_id is not None)


def test_langid_repeated_rows_and_clashing_columns(spark, documents):
    rows = corpus(60)
    schema = "doc_id long, text string, lang string, source string, n_chars long, lang_pred string, score string, held_out int, p int, word string"
    folder = documents([(*r, "zz", "s", 1, 2, "w") for r in [*rows, rows[0], rows[0]]], schema)
    got = langid.op7_langid(spark, folder).collect()
    assert len(got) == 62 and len({(r.lang_pred, r.score) for r in got if r.doc_id == 0}) == 1
    assert {r.lang_pred for r in got} == {"en", "de"}


def test_langid_nothing_to_learn(spark, documents):
    assert langid.op7_langid(spark, documents([])).collect() == []
    got = langid.op7_langid(spark, documents([(1, "text", None, "a", 0), (2, None, "en", "a", 0)])).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)] * 2


def plain_scores(rows):
    """An uncut interpolated modified Kneser-Ney trigram model over dictionaries."""
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [1]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    grams = lambda x: list(zip([0, 0, *x], [0, *x], x, strict=False))
    c3 = Counter(g for i, t, *_ in rows if not held(i) for g in grams(split(t)))
    count = Counter()
    for (_, _, w), c in c3.items():
        count[w] += c
    c2, c1 = Counter(), Counter()
    for (u, v, w), c in c3.items():
        c2[v, w] += c if v == 0 else 1
    for _, w in c2:
        c1[w] += 1
    levels = []
    for counts in (c1, c2, c3):
        often = Counter(counts.values())
        d = lm.discounts([often[k] for k in (1, 2, 3, 4)])
        totals, left = Counter(), Counter()
        for gram, c in counts.items():
            context = gram[:-1] if isinstance(gram, tuple) else ()
            totals[context] += c
            left[context] += d[min(c, 3) - 1]
        levels.append((counts, d, totals, left))
    n, kinds = sum(count.values()), len(count)

    def p(gram):
        if not gram:
            return 1 / (kinds + 1)
        counts, d, totals, left = levels[len(gram) - 1]
        lower, c = p(gram[1:]), counts.get(gram if len(gram) > 1 else gram[0], 0)
        if not totals[gram[:-1]]:
            return lower
        return ((c - d[min(c, 3) - 1] if c else 0) + left[gram[:-1]] * lower) / totals[gram[:-1]]

    out = []
    for i, t, *_ in rows:
        x = split(t)
        base = sum(math.log10((count[w] + 0.1) / (n + 0.1 * (kinds + 1))) for w in x)
        score = sum(math.log10(p(g)) for g in grams(x))
        out.append((i is None, i or 0, held(i), len(x), sum(count[w] > 0 for w in x), n, round(base, 6), round(score, 6)))
    return sorted(out)


@pytest.mark.parametrize("part_tokens, combined", [(1 << 21, 1 << 22), (60, 1 << 22), (400, 33)])
def test_lm(spark, documents, awkward, monkeypatch, part_tokens, combined):
    """With small parts, frequent words, frequent pairs and the start of texts are dealt to several."""
    monkeypatch.setattr(lm, "PART_TOKENS", part_tokens)
    monkeypatch.setattr(lm, "COMBINED", combined)
    monkeypatch.setattr(lm, "NOTED", 1)
    monkeypatch.setattr(lm, "STRIDE", lm.WINDOW)
    rows = corpus(60) + [(r[0] + 1000 if r[0] is not None else None, *r[1:]) for r in awkward]
    rows += [(2000 + i, f"the cat {i % 7} sat on mat {i * i % 11} once{i} only{i} and a dog{i % 5}", "en", "a", 0) for i in range(30)]
    folder = documents(rows)
    deal = lm.survey(spark.read.parquet(f"{folder}/documents.parquet").where("text IS NOT NULL"))
    assert (deal.parts == 1) == (part_tokens > 1000) and (deal.parts == 1 or len(deal.words) and (part_tokens > 60 or len(deal.pairs)))
    got = lm.op9_lm(spark, folder).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got) == plain_scores(rows)


def test_lm_shares_sum_to_one(spark):
    docs = spark.createDataFrame([(t,) for t in ("a b a b c", "b a c", "a", "c c b a")], "text string")
    scorer = lm.Scorer(lm.learn(docs))
    for context in ("", "a", "a b", "zz", "b zz"):
        whole = scorer.score([context])["score"][0]
        longer = [scorer.score([f"{context} {w}"]) for w in ("a", "b", "c", "unseen")]
        # what a text without its end has, from the shares of its end
        ends = []
        for w, s in zip(("a", "b", "c", "unseen"), longer, strict=True):
            ends.append(10 ** (s["score"][0] - end_of(scorer, f"{context} {w}")))
        assert abs(sum(ends) + 10**whole - 10 ** (whole - end_of(scorer, context))) < 1e-9


def end_of(scorer, text):
    """log10 of the end's share after a text: by a model of the same arrays, from the difference that the end makes."""
    m = scorer.model
    u, v = ([lm.START, lm.START, *lm.tokens(text)[:-1]])[-2:]
    u, v, w = (lm.np.array([x], dtype=lm.np.uint64) for x in (u, v, lm.END))
    c = scorer._find(1, m.deal.part(u, v, w), lm.mix(u, v, w), 1)[:, 0]
    after = scorer._find(2, m.deal.part(u, v, w), lm.mix(u, v), 4)
    a = scorer._find(3, scorer._home(v), lm.mix(v, w), 1)[:, 0]
    follow = scorer._find(0, scorer._home(v), v, 6)[:, 2:]
    p1 = lm._discounted(lm.np.array([m.before_end]), m.discounts[0]) / m.pair_kinds + m.rest / (m.kinds + 1)
    p2 = lm._discounted(a, m.discounts[1]) / max(follow[0, 0], 1) + lm._left(follow, m.discounts[1]) * p1
    p3 = lm._discounted(c, m.discounts[2]) / max(after[0, 0], 1) + lm._left(after, m.discounts[2]) * p2
    return math.log10(p3[0])


def test_lm_table():
    rnd = lm.np.random.default_rng(3)
    for n in (0, 1, 31, 33, 5000):
        keys = rnd.integers(0, 1 << 64, n, dtype=lm.np.uint64)
        values = rnd.integers(0, 300, (n, 2))
        data, sizes = lm.Table.to_bytes(keys, values)
        t, end = lm.Table.from_bytes(lm.np.frombuffer(data, dtype=lm.np.uint8), 0, *sizes)
        assert end == len(data)
        asked = lm.np.concatenate([keys, rnd.integers(0, 1 << 64, 1000, dtype=lm.np.uint64)])
        hit, rows = t.find(asked)
        assert hit.tolist() == list(range(n)) and rows.tolist() == values.tolist()


def test_lm_empty(spark, documents):
    assert lm.op9_lm(spark, documents([])).collect() == []
    got = lm.op9_lm(spark, documents([(12, "held out only", "en", "a", 0)])).collect()
    assert len(got) == 1 and got[0].score <= 0


def test_few_files_are_mapped_of_a_model_of_many_parts(spark, documents, monkeypatch):
    monkeypatch.setattr(lm, "PART_TOKENS", 2)
    monkeypatch.setattr(lm, "STRIDE", lm.WINDOW)
    rnd = lm.np.random.default_rng(4)
    texts = [" ".join(f"w{k}" for k in rnd.zipf(1.4, 60) % 3000) for _ in range(300)]
    docs = spark.read.parquet(f"{documents([(i, t, 'en', 'a', 0) for i, t in enumerate(texts)])}/documents.parquet").select("text")
    model = lm.learn(docs)
    assert len(model.parts) > 1500
    want = lm.Scorer(model)
    monkeypatch.setattr(lm, "MAX_OPEN", 1 << 20)
    want = want.score(texts[:40])
    monkeypatch.setattr(lm, "MAX_OPEN", 16)
    few = lm.Scorer(model)
    held = lambda: sum("lm-arrays" in line for line in open("/proc/self/maps"))  # noqa: E731, SIM115
    got = few.score(texts[:40])
    assert len(few.mapped) == 16 and held() <= 40
    assert got.equals(want)
