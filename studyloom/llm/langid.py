"""Operator 7: language identification by interpolated Kneser-Ney character models, one per language.

Spark counts words by language, and from the distinct words the character n-grams of the highest order; the lower
orders count the distinct characters before a gram. No gram is left out. Tasks write the models as arrays sorted
by a hash of the gram, with a column per language, a file for each range of hashes, to the shared folder; workers map
the files and score a word once for all its occurrences, as contexts begin anew at each word. A text's language is that of the lowest cross-entropy per character; how sure that is, and whether the text is rejected, is
calibrated on all rows learned from: every text is scored once, and Spark aggregates what calibration needs of the entropies.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from studyloom.llm import arrays
from studyloom.llm.common import crc_mod, small_batches, table
from studyloom.storage import new_path, staged

ORDER, START, END = 4, "\x02", "\x03"
#: Values of one file of the models on average.
FILE_ROWS = 1 << 20
#: Words that a worker remembers; distinct words that a task holds before it hands them on; words scored at once.
CACHE, HELD, SCORED = 400_000, 300_000, 20_000
#: Own-language share of texts that calibration leaves unrejected; how sharply entropy differences may turn into scores.
KEPT, SHARP = 0.995, [2.0**k for k in range(-1, 7)]

_WORD = re.compile(r"[^\W\d_]+")


def word_counts(docs: DataFrame) -> DataFrame:
    """docs(text, lang), none null -> lang, word, n. Tasks combine before the shuffle."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()

        def rows() -> pd.DataFrame:
            out = pd.DataFrame([(*k, n) for k, n in held.items()], columns=["lang", "word", "n"])
            held.clear()
            return out

        for pdf in batches:
            for text, lang in zip(pdf.text, pdf.lang, strict=True):
                for word, n in Counter(_WORD.findall(text.lower())).items():
                    held[lang, word] += n
            if len(held) > HELD:
                yield rows()
        if held:
            yield rows()

    return docs.select("text", "lang").mapInPandas(counted, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _discounted(grams: DataFrame, order: int) -> DataFrame:
    """grams(lang, gram, c) of one order -> order, lang, gram, share, context, rest: the gram's discounted share of
    its context, and what the context leaves to the lower order."""
    d = grams.groupBy("lang").agg(F.sum(F.when(F.col("c") == 1, 1).otherwise(0)).alias("n1"), F.sum(F.when(F.col("c") == 2, 1).otherwise(0)).alias("n2"))
    d = d.select("lang", F.when(F.col("n1") > 0, F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(0.5).alias("d"))
    d = d.withColumn("d", F.least(F.col("d"), F.lit(0.95)))
    g = grams.withColumn("context", F.left("gram", F.lit(order - 1)))
    held = g.groupBy("lang", "context").agg(F.sum("c").alias("total"), F.count(F.lit(1)).alias("types"))
    g = g.join(held, ["lang", "context"]).join(F.broadcast(d), "lang")  # d: a row per language
    share = F.greatest(F.col("c") - F.col("d"), F.lit(0.0)) / F.col("total")
    return g.select(F.lit(order).alias("order"), "lang", "gram", share.alias("share"), "context", (F.col("d") * F.col("types") / F.col("total")).alias("rest"))


def count_grams(words: DataFrame) -> DataFrame:
    """words(lang, word, n) -> lang, gram, c of the highest order."""
    padded = F.concat(F.lit(START * (ORDER - 1)), "word", F.lit(END))
    at = F.explode(F.sequence(F.lit(1), F.length("word") + 1)).alias("at")
    return words.select("lang", "n", padded.alias("p"), at).groupBy("lang", F.substring("p", F.col("at"), F.lit(ORDER)).alias("gram")).agg(F.sum("n").alias("c"))


def estimates(grams: DataFrame) -> DataFrame:
    parts, g = [], grams
    for order in range(ORDER, 0, -1):
        parts.append(_discounted(g, order))
        g = g.groupBy("lang", F.substring("gram", 2, order).alias("gram")).agg(F.count(F.lit(1)).alias("c"))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


HASHED = "order int, lang string, gram long, share float, context long, rest float"


def hash_estimates(found: DataFrame) -> DataFrame:
    """Estimates with 64-bit hashes for grams and contexts."""

    def hash_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for order, p in pdf.groupby("order"):  # nothing comes of an empty batch
                c = codes(list(p.gram), int(order))
                yield pd.DataFrame(
                    {"order": p.order, "lang": p.lang, "gram": hashed(c).view(np.int64), "share": p.share, "context": hashed(c[:, :-1]).view(np.int64), "rest": p.rest}
                )

    return found.mapInPandas(hash_rows, HASHED)


def codes(grams: list[str], width: int) -> np.ndarray:
    return np.frombuffer("".join(grams).encode("utf-32-le"), dtype="<u4").reshape(-1, width).astype(np.uint64)


def hashed(columns: np.ndarray) -> np.ndarray:
    """64-bit hash of each row of code points."""
    h = np.full(len(columns), 0x9E3779B97F4A7C15, dtype=np.uint64)
    for k in range(columns.shape[1]):
        h = (h ^ columns[:, k]) * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(32)
    return h


def write_models(found: DataFrame, langs: list[str], path: str) -> list[tuple[int, str, int, int, str, int]]:
    """Hashed estimates -> order, name (gram or context), bits, range, file, keys: a row for each file.

    A table's range is the first bits of the hash; a file holds sorted keys, then a row of languages for each."""
    place = F.array_position(F.array(*[F.lit(x) for x in langs]), F.col("lang")).cast("int") - 1
    values = F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("key"), F.col(v).alias("v")) for n, v in (("gram", "share"), ("context", "rest"))])
    rows = found.select("order", place.alias("at"), F.explode(values).alias("x")).select("order", "at", "x.*")
    held = {r.order: r["count"] for r in found.groupBy("order").count().collect()}
    bits = {order: max(0, (n * len(langs) // FILE_ROWS).bit_length()) for order, n in held.items()}
    by_order = F.create_map(*[F.lit(x) for pair in bits.items() for x in pair])[F.col("order")]
    part = F.when(by_order == 0, 0).otherwise(F.expr("shiftrightunsigned(key, 64 - bits)"))

    def write(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        order, name, bits, part = key
        kinds, which = np.unique(pdf["key"].to_numpy().view(np.uint64), return_inverse=True)
        filled = np.full((len(kinds), len(langs)), DEFAULT[name], dtype="<f4")
        filled[which, pdf["at"].to_numpy()] = pdf["v"].to_numpy()
        file = arrays.write(path, [kinds.astype("<u8").tobytes(), filled.tobytes()])
        return pd.DataFrame({"order": [order], "name": [name], "bits": [bits], "part": [part], "file": [file], "n": [len(kinds)]})

    dealt = rows.withColumn("bits", by_order).withColumn("part", part.cast("int")).groupBy("order", "name", "bits", "part")
    return [tuple(r) for r in dealt.applyInPandas(write, "order int, name string, bits int, part int, file string, n int").collect()]


#: What an absent key stands for: no share of its own; nothing taken from the lower order.
DEFAULT = {"gram": 0.0, "context": 1.0}


class Table:
    """Values by language for the 64-bit keys of one order."""

    def __init__(self, name: str, langs: int, files: list[tuple[int, int, str, int]]):
        self.default, self.langs, self.parts, self.bits = DEFAULT[name], langs, {}, 0
        for self.bits, part, file, n in files:
            data = arrays.mapped(file)
            self.parts[part] = data[: 8 * n].view("<u8"), data[8 * n :].view("<f4").reshape(n, langs)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        out = np.full((len(keys), self.langs), self.default)
        spot = keys >> np.uint64(64 - self.bits) if self.bits else np.zeros(len(keys), dtype=np.uint64)
        for part in np.unique(spot).tolist() if self.bits else [0]:
            if part in self.parts:
                known, values = self.parts[part]
                mine = np.flatnonzero(spot == part) if self.bits else np.arange(len(keys))
                at = np.minimum(np.searchsorted(known, keys[mine]), len(known) - 1)
                hit = known[at] == keys[mine]
                out[mine[hit]] = values[at[hit]]
        return out


@dataclass
class Models:
    """What is broadcast: languages, names of files, and the calibration."""

    langs: list[str]
    files: list[tuple[int, str, int, int, str, int]]
    #: Probability of a character that no language has seen.
    unseen: float
    sharpness: float = 10.0
    limits: np.ndarray | None = None

    def tables(self, name: str) -> list[Table]:
        return [Table(name, len(self.langs), [f[2:] for f in self.files if f[:2] == (order, name)]) for order in range(1, ORDER + 1)]

    def predict(self, text_entropies: np.ndarray | None) -> tuple[str, float, bool]:
        if text_entropies is None or not self.langs:
            return "und", 0.0, True
        best = int(np.argmin(text_entropies))
        share = 1 / np.exp((text_entropies[best] - text_entropies) * self.sharpness).sum()
        limit = np.inf if self.limits is None else self.limits[best]
        over = text_entropies[best] > limit
        return self.langs[best], float(share * (limit / text_entropies[best] if over else 1)), bool(over)


class Scorer:
    """Scores texts and remembers words, up to CACHE of them."""

    def __init__(self, models: Models):
        self.models = models
        self.shares, self.rests = models.tables("gram"), models.tables("context")
        self.forget()

    def words(self, words: list[str]) -> np.ndarray:
        """Log-probability of each word and its end, a column per language."""
        text = np.frombuffer("".join([START * (ORDER - 1) + w + END for w in words]).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
        begins = np.cumsum(sizes + ORDER - 1) - sizes
        spots = np.repeat(begins - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        p = np.full((len(spots), len(self.models.langs)), self.models.unseen)
        for order in range(1, ORDER + 1):
            window = np.stack([text[spots - k] for k in range(order - 1, -1, -1)], axis=1)
            p = self.shares[order - 1](hashed(window)) + self.rests[order - 1](hashed(window[:, :-1])) * p
        return np.add.reduceat(np.log(p), np.cumsum(sizes) - sizes, axis=0)

    def forget(self):
        self.at: dict[str, int] = {}
        self.rows = np.empty((0, len(self.models.langs)))

    def entropies(self, texts: list[str]) -> list[np.ndarray | None]:
        """Cross-entropy per character by language; None for a text without letters."""
        if not self.models.langs:
            return [None] * len(texts)
        split = [_WORD.findall(t.lower()) for t in texts]
        new = list(set().union(*split) - self.at.keys())
        if len(self.at) + len(new) > CACHE:
            self.forget()
            new = list(set().union(*split))
        if new:
            self.at |= zip(new, range(len(self.at), len(self.at) + len(new)), strict=True)
            parts = [self.words(new[i : i + SCORED]) for i in range(0, len(new), SCORED)]
            self.rows = np.concatenate([self.rows, *parts])
        out = []
        for words in split:
            if not words or not any(c.isalpha() for w in words for c in w):
                out.append(None)
                continue
            rows = self.rows[[self.at[w] for w in words]]
            out.append(-rows.sum(axis=0) / (sum(map(len, words)) + len(words)))
        return out


def entropies(text: Column, models: Models) -> Column:
    """array<double>: a text's cross-entropy per character by language; null for a text that is null or has no letter."""
    shared = SparkSession.getActiveSession().sparkContext.broadcast(models)

    @F.pandas_udf("array<double>")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(shared.value)
        for texts in batches:
            yield pd.Series(scorer.entropies(list(texts)), dtype=object)

    return scored(F.coalesce(text, F.lit("")))


def quantiles(values: DataFrame, share: float) -> DataFrame:
    """values(at, v) -> at, q: each group's quantile over all its rows, interpolated between the two ranks around it.

    Ranks are prefix sums over ranges of the distinct values, so that a group of any size spreads."""
    ranged = staged(values.groupBy("at", "v").agg(F.count(F.lit(1)).alias("n")).repartitionByRange("at", "v").withColumn("part", F.spark_partition_id()), "langid-own")
    before = W.partitionBy("at").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = ranged.groupBy("at", "part").agg(F.sum("n").alias("n"))
    parts = parts.select("at", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), F.sum("n").over(W.partitionBy("at")).alias("total"))
    inside = F.sum("n").over(W.partitionBy("at", "part").orderBy("v"))
    end = F.col("inside") + F.col("start")
    spot = (F.col("total") - 1) * F.lit(share)
    low, high = F.floor(spot), F.ceil(spot)
    holds = lambda rank: (rank >= end - F.col("n")) & (rank < end)
    placed = ranged.withColumn("inside", inside).join(parts, ["at", "part"])
    found = placed.groupBy("at").agg(F.max(F.when(holds(low), F.col("v"))).alias("l"), F.max(F.when(holds(high), F.col("v"))).alias("h"), F.max(spot - low).alias("f"))
    return found.select("at", (F.col("l") + (F.col("h") - F.col("l")) * F.col("f")).alias("q"))


def calibrated(models: Models, scored: DataFrame) -> Models:
    """scored(lang, e): entropies of all rows learned from. Sets how sharply entropy differences turn into scores, by the
    likelihood of the right languages, and each language's limit: the entropy that KEPT of its own texts stay below, and a
    tenth more. The driver gets a sum for each sharpness and a row for each language."""
    place = F.array_position(F.array(*[F.lit(x) for x in models.langs]), F.col("lang")).cast("int")
    known = scored.where("e IS NOT NULL").select("e", place.alias("at")).where("at > 0").select("e", F.col("at") - 1, F.get("e", F.col("at") - 1)).toDF("e", "at", "v")
    odds = lambda s: F.aggregate("e", F.lit(0.0), lambda n, x: n + F.exp(F.least((F.col("v") - x) * F.lit(s), F.lit(50.0))))
    sums = known.agg(*[F.sum(F.log(odds(s))).alias(f"s{k}") for k, s in enumerate(SHARP)]).first()
    if sums[0] is None:
        return models
    limits = np.full(len(models.langs), np.inf)
    for r in quantiles(known.select("at", "v"), KEPT).collect():
        limits[r["at"]] = r.q * 1.1
    return replace(models, sharpness=min(zip(sums, SHARP, strict=True))[1], limits=limits)


def taught(docs: DataFrame) -> DataFrame:
    return docs.where("text IS NOT NULL AND lang IS NOT NULL")


def fitted(docs: DataFrame) -> Models:
    """docs(text, lang): rows to learn from; those without text or language do not count. Models before calibration."""
    grams = staged(count_grams(word_counts(taught(docs))), "langid-grams")
    found = staged(hash_estimates(estimates(grams)), "langid-models")
    langs = sorted(r.lang for r in found.select("lang").distinct().collect())  # a row per language
    if not langs:
        return Models([], [], 0.0)
    files = write_models(found, langs, new_path(docs.sparkSession, "langid-arrays"))
    characters = sum(n for order, name, *_, n in files if (order, name) == (1, "gram"))
    return Models(langs, files, 1 / (characters + 1))


def learn(docs: DataFrame) -> Models:
    """docs(text, lang): rows to learn from and to calibrate on, all that have a text and a language."""
    models = fitted(docs)
    if not models.langs:
        return models
    return calibrated(models, staged(taught(docs).select("lang", entropies(F.col("text"), models).alias("e")), "langid-scored"))


def judged(found: Column, models: Models) -> Column:
    """struct<lang_pred, score, rejected> of a text's entropies. Without any it is ``und`` with score 0."""
    shared = SparkSession.getActiveSession().sparkContext.broadcast(models)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield pd.DataFrame([shared.value.predict(e) for e in rows], columns=["lang_pred", "score", "rejected"])

    return predicted(found)


def identify(text: Column, models: Models) -> Column:
    """struct<lang_pred, score, rejected>. A text that is null or has no letter is ``und`` with score 0."""
    return judged(entropies(text, models), models)


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose crc32 modulo 4 is 2 are held out.

    Every text is scored once, and the entropies of all rows learned from calibrate. Null, empty and letterless texts are
    ``und`` with score 0; rows with a null language or text teach and calibrate nothing, those with a null id are taken
    like others; repeated rows count as often as they occur and get equal predictions; extra columns do not matter; an
    empty table gives an empty result."""
    small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    models = fitted(docs.where(~held_out))
    scored = docs.select("doc_id", held_out.alias("held_out"), F.when(F.col("text").isNotNull(), F.col("lang")).alias("lang"), entropies(F.col("text"), models).alias("e"))
    scored = staged(scored, "langid-scored")
    if models.langs:
        models = calibrated(models, scored.where("NOT held_out"))
    return scored.select("doc_id", "held_out", judged(F.col("e"), models).alias("p")).select("doc_id", "held_out", "p.*")
