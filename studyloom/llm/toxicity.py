"""Operator 6: toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The features are densities of a lexicon's words and word beginnings, how near to second-person words its hits lie,
capitals, punctuation, and rates of obfuscated spellings. The lexicon joins a few general insults to the terms whose
document frequency among toxic rows stands out. It is learned on one half of the labelled sample, the trees on most
of the other half, and the calibration on the rest, so that none judges the rows it has learned from.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studyloom.llm.common import crc_mod, small_batches, table
from studyloom.storage import staged

#: Labelled rows learned from at most (the first by hash of the id).
MAX_LABELLED = 20000
#: Toxic rows that a term of the lexicon occurs in at least, and how many times commoner it is among them.
MIN_DOCS, MIN_RATIO = 4, 6.0
CUTOFF = 0.7
#: A word's beginning that may be a term, and how many words away a second person counts as near.
STEM, NEAR = 4, 5
#: Columns that scoring adds for itself.
FEATURES, PROBABILITY, RAW, CALIBRATED = "_toxicity_features", "_toxicity_probability", "_toxicity_raw", "_toxicity_calibrated"

# General insults and second-person words. Fixed values.
INSULTS = (
    "asshole", "bastard", "bitch", "clown", "crap", "cretin", "damn", "disgusting", "dumb", "filthy", "freak", "garbage", "hate", "idiot",
    "imbecile", "jerk", "loser", "moron", "pathetic", "pig", "retard", "scum", "shit", "stupid", "trash", "ugly", "vermin", "worthless",
    "abschaum", "arschloch", "depp", "dreck", "dumm", "ekelhaft", "trottel", "wertlos", "abruti", "connard", "crétin", "débile", "imbécile",
    "salaud", "basura", "cabrón", "escoria", "estúpido", "imbécil", "inútil", "asqueroso", "tonto",
)
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos tú tu ti tus usted ustedes vosotros".split()
)
LEET = str.maketrans("013457@$!|", "oieastasil")

NAMES = (
    "lexicon", "weighted", "distinct", "strongest", "stems", "distinct_stems", "near_second_person", "second_person", "capitals",
    "shouted", "exclamations", "questions", "punctuation", "obfuscated", "mixed", "length",
)

_WORD = re.compile(r"[^\W\d_]+")
_MIXED = re.compile(r"(?<![\w@$!|])[^\W\d_]*+[0-9@$!|]++[^\W\d_][\w@$!|]*+")
_SPACED = re.compile(r"(?<!\w)(?:[^\W\d_][ .*_-]){3,}[^\W\d_](?!\w)")
_GAPS = re.compile(r"[ .*_-]")
_DRAWN = re.compile(r"([^\W\d_])\1{2,}")
_SHOUTED = re.compile(r"\b[A-Z]{3,}\b")
_PUNCTUATION = np.zeros(256, dtype=bool)
_PUNCTUATION[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def stem(word: str) -> str | None:
    return f"{word[:STEM]}*" if len(word) > STEM else None


def terms(text: str) -> set[str]:
    """What a text can have of a lexicon: its words, and their beginnings with a star."""
    words = set(_WORD.findall(text.lower()))
    return words | {s for w in words if (s := stem(w))}


def features(text: str, lexicon: dict[str, float]) -> list[float]:
    """In the order of NAMES. An empty text has zeros."""
    low = text.lower()
    words = _WORD.findall(low)
    mixed = _MIXED.findall(low)
    hidden = [m.translate(LEET) for m in mixed] + [_GAPS.sub("", m) for m in _SPACED.findall(low)]
    hidden += [_DRAWN.sub(r"\1", w) for w in words if _DRAWN.search(w)] if _DRAWN.search(low) else []
    hidden = [w for w in hidden if w in lexicon]
    count = Counter(words)
    count.update(hidden)  # a disguised hit is a hit
    n = max(1, len(words))
    hits = {w: lexicon[w] for w in count if w in lexicon}
    stems = {w: lexicon[s] for w in count if (s := stem(w)) in lexicon}
    n_hits = sum(count[w] for w in hits)
    near = 0
    if hits:
        for i, w in enumerate(words):
            if w in hits and not SECOND_PERSON.isdisjoint(words[max(0, i - NEAR) : i + NEAR + 1]):
                near += 1
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    size = max(1, len(data))
    upper = int(np.count_nonzero((data >= 65) & (data <= 90)))
    return [
        n_hits / n,
        sum(v * count[w] for w, v in hits.items()) / n,
        math.log1p(len(hits)),
        max(hits.values(), default=0.0),
        sum(count[w] for w in stems) / n,
        math.log1p(len(stems)),
        near / max(1, n_hits),
        sum(count[w] for w in SECOND_PERSON if w in count) / n,
        upper / size,
        len(_SHOUTED.findall(text)) / n,
        text.count("!") / n,
        text.count("?") / n,
        int(np.count_nonzero(_PUNCTUATION[data])) / size,
        len(hidden) / n,
        len(mixed) / n,
        math.log1p(len(words)),
    ]


def with_features(docs: DataFrame, text: Column, lexicon: dict[str, float]) -> DataFrame:
    """docs with the vector FEATURES. A null text is empty."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)  # bounded with the labelled rows, see learn_lexicon

    @F.pandas_udf("array<double>")
    def dense(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([features(t, shared.value) for t in texts], dtype=object)

    return docs.withColumn(FEATURES, array_to_vector(dense(F.coalesce(text, F.lit("")))))


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs(doc_id, text), labels(doc_id, toxic) -> doc_id, text, label, fold (0 to 9): at most MAX_LABELLED labels,
    few enough to be broadcast. An id labelled both ways counts as toxic; null labels do not count."""
    h = F.xxhash64("doc_id")
    some = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("double").alias("label"))
    some = some.orderBy(h, "doc_id").limit(MAX_LABELLED)
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(some), "doc_id")
    return staged(found.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(10)).cast("int")), "toxicity-labelled")


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """rows(text, label) -> weight by term: the log of how much commoner among toxic rows. Every term that stands out
    is taken; half of MAX_LABELLED rows bound them, as each is in MIN_DOCS of these at least."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            by_label = {0.0: Counter(), 1.0: Counter()}
            for text, label in zip(pdf.text, pdf.label, strict=True):
                by_label[label].update(terms(text))
            for label, c in by_label.items():
                if c:  # of an empty frame Arrow can't tell that terms are strings
                    yield pd.DataFrame({"term": pd.Series(list(c), dtype=object), "label": label, "n": list(c.values())})

    total = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(total) < 2:
        return {w: 1.0 for w in INSULTS}
    sums = [F.sum(F.when(F.col("label") == v, F.col("n")).otherwise(0)).alias(c) for v, c in ((1.0, "bad"), (0.0, "good"))]
    found = rows.select("text", "label").mapInPandas(counted, "term string, label double, n long").groupBy("term").agg(*sums)
    ratio = (F.col("bad") + 0.5) / (total[1.0] + 1) / ((F.col("good") + 0.5) / (total[0.0] + 1))
    found = found.withColumn("ratio", ratio).where((F.col("bad") >= MIN_DOCS) & (F.col("ratio") >= MIN_RATIO))
    return {w: 1.0 for w in INSULTS} | {r.term: math.log(r.ratio) for r in found.collect()}


@dataclass
class Model:
    lexicon: dict[str, float]
    trees: GBTClassificationModel | None
    curve: IsotonicRegressionModel | None
    rate: float

    def score(self, docs: DataFrame, text: Column) -> DataFrame:
        """docs with ``score``: the calibrated probability, and a hundredth of the raw one to order its steps."""
        if self.trees is None:
            return docs.withColumn("score", F.lit(self.rate))
        d = self.trees.transform(with_features(docs, text, self.lexicon))
        d = self.curve.transform(d.withColumn(RAW, vector_to_array(PROBABILITY)[1]))
        return d.select(*docs.columns, (F.col(CALIBRATED) * 0.99 + F.col(RAW) * 0.01).alias("score"))


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """docs(doc_id, text), labels(doc_id, toxic): rows to learn from. Without both labels the score is their rate."""
    rows = labelled_texts(docs, labels)
    by_fold = {r.fold: (r.n, r.bad) for r in rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("bad")).collect()}
    parts = [range(0, 5), range(5, 8), range(8, 10)]
    sums = [[sum(by_fold.get(f, (0, 0))[i] for f in part) for i in range(2)] for part in parts]
    n, bad = (sum(s[i] for s in sums) for i in range(2))
    if not 0 < bad < n:
        return Model({}, None, None, float(bad / n) if n else 0.0)
    if any(not 5 <= b <= m - 5 for m, b in sums):  # too few to divide
        parts = [range(10)] * 3
    of = lambda part: F.col("fold").isin(*part)
    lexicon = learn_lexicon(rows.where(of(parts[0])))
    known = with_features(rows.where(of({*parts[1], *parts[2]})), F.col("text"), lexicon)
    known = staged(known.select("label", "fold", vector_to_array(FEATURES).alias("f")), "toxicity-features").withColumn(FEATURES, array_to_vector("f"))
    small = min(5, max(1, int(bad) // 10))
    trees = GBTClassifier(featuresCol=FEATURES, maxIter=20, maxDepth=3, stepSize=0.2, minInstancesPerNode=small, seed=6, checkpointInterval=-1)
    trees.setPredictionCol("_toxicity_class").setProbabilityCol(PROBABILITY).setRawPredictionCol("_toxicity_margin")
    trees = trees.fit(known.where(of(parts[1])))
    raw = trees.transform(known.where(of(parts[2]))).select("label", vector_to_array(PROBABILITY)[1].alias(RAW))
    curve = IsotonicRegression(featuresCol=RAW, labelCol="label", predictionCol=CALIBRATED).fit(raw)
    return Model(lexicon, trees, curve, float(bad / n))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its score. Labels of rows whose crc32 modulo 3 is 1 are held out.

    Documents without a label, with a null or empty text or with a null id are scored like the others; repeated rows
    get equal scores; labels that are null or neither 0 nor 1 do not count; without labels of both kinds the score is
    their rate (0 without any); an empty table gives an empty result."""
    small_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = learn(docs, labels.where(crc_mod(F.col("doc_id"), 3) != 1))
    out = model.score(docs, F.col("text"))
    return out.select(
        "doc_id", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= CUTOFF).cast("int").alias("predicted")
    )


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the model does not reject, all their columns as they are, whatever their names.

    Nulls, repeated rows and empty tables as in ``op6_toxicity``: a null text is scored as an empty one, each repeated
    row stays or goes with its text, and no documents give no documents. Labels of one kind teach nothing, so that
    all documents stay."""
    model = learn(docs, labels.where(crc_mod(F.col("doc_id"), 3) != 1))
    if model.trees is None:
        return docs
    rows = docs.select(F.struct("*").alias("doc"), F.col("text"))
    return model.score(rows, F.col("text")).where(F.col("score") < CUTOFF).select("doc.*")
