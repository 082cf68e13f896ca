"""Operator 3: document fingerprints by SimHash, and permuted block tables.

The terms of a text are its pairs of adjacent words. A term's 128 hash bits vote, plus for a set bit and minus for
a clear one, with the term's weight: twice for the longer pairs, which say more about a text. Sixteen-bit counters
are summed four to a long, so a term costs 32 additions inside the generated code of an aggregation.

A search over fingerprints uses ``radius + 1`` block tables: fingerprints within the radius agree in a block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from studyloom.llm.common import lower_ascii, table
from studyloom.storage import staged

#: Bits of a fingerprint; terms of one partial count: with weights of 2 a counter stays below 2^15, so that the topmost of a
#: signed long does not overflow either.
BITS, CHUNK = 128, 16000
#: Characters from which on a pair of words counts double.
LONG_PAIR = 8
#: Documents of a bin of the id order on average, and how many bins there may be: their table is broadcast.
BIN_ROWS, MAX_BINS, FAN = 512, 65536, 256
LANES16, LANES32 = 0x0001000100010001, 0x0000FFFF0000FFFF


def words_of(text: Column) -> Column:
    return F.filter(F.split(lower_ascii(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def terms(words: Column) -> Column:
    """array<struct<a, b>> of adjacent words; a lone word stands with the empty one, and no word makes no term."""
    after = F.concat(F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))), F.array(F.lit("")))
    pairs = F.arrays_zip(words.alias("a"), after.alias("b"))
    return F.slice(pairs, F.lit(1), F.when(F.size(words) > 1, F.size(words) - 1).otherwise(F.size(words)))


def _votes(term: Column) -> list[Column]:
    """Weighted counts of set bits, 4 counters to a long: bit k of half s is counter k // 16 of sum s * 16 + k % 16."""
    out = []
    for seed in range(2):
        h = F.col(f"h{seed}")
        out += [F.sum(F.shiftrightunsigned(h, k).bitwiseAND(F.lit(LANES16)) * F.col("w")).alias(f"v{seed * 16 + k}") for k in range(16)]
    return out


def fingerprints(texts: DataFrame, keys: list[str]) -> DataFrame:
    """texts(*keys, text), keys unique and not null -> keys, hi, lo: two longs of 64 bits. No words: zeros."""
    # split once: a generator's own expression would be evaluated for each of its uses
    d = texts.select(*keys, words_of(F.col("text")).alias("words"))
    d = d.select(*keys, F.posexplode_outer(terms(F.col("words"))).alias("pos", "t"))
    d = d.select(
        *keys,
        F.floor(F.coalesce("pos", F.lit(0)) / CHUNK).alias("chunk"),
        F.coalesce(F.xxhash64("t.a", "t.b"), F.lit(0)).alias("h0"),
        F.coalesce(F.xxhash64("t.b", F.lit(1), "t.a"), F.lit(0)).alias("h1"),
        F.when(F.col("t").isNull(), 0).when(F.length("t.a") + F.length("t.b") >= LONG_PAIR, 2).otherwise(1).cast("long").alias("w"),
    )
    part = d.groupBy(*keys, "chunk").agg(F.sum("w").alias("w"), *_votes(F.col("t")))
    wide = [F.sum(F.shiftrightunsigned(F.col(f"v{i}"), s).bitwiseAND(F.lit(LANES32))).alias(f"s{i}_{s}") for i in range(32) for s in (0, 16)]
    full = part.groupBy(*keys).agg(F.sum("w").alias("w"), *wide)

    def word(half: int) -> Column:
        bits = F.lit(0).cast("long")
        for k in range(64):
            lane, i = k // 16, half * 16 + k % 16
            count = F.shiftrightunsigned(F.col(f"s{i}_{16 * (lane % 2)}"), 32 * (lane // 2)).bitwiseAND(F.lit(0xFFFFFFFF))
            set_bit = 1 << k if k < 63 else -(1 << 63)
            bits = bits.bitwiseOR(F.when(count * 2 > F.col("w"), F.lit(set_bit)).otherwise(F.lit(0)).cast("long"))
        return bits

    return full.select(*keys, word(0).alias("hi"), word(1).alias("lo"))


def distance(a_hi: Column, a_lo: Column, b_hi: Column, b_lo: Column) -> Column:
    return F.bit_count(a_hi.bitwiseXOR(b_hi)) + F.bit_count(a_lo.bitwiseXOR(b_lo))


def likeness(*halves: Column) -> Column:
    return (F.lit(BITS) - distance(*halves)) / F.lit(float(BITS))


def block_values(hi: Column, lo: Column, radius: int) -> list[Column]:
    """radius + 1 blocks of nearly equal width, none across the halves; each table is permuted to lead with one."""
    left = (radius + 2) // 2
    out = []
    for half, parts in ((hi, left), (lo, radius + 1 - left)):
        edges = [64 * k // parts for k in range(parts + 1)] if parts else []
        out += [F.shiftrightunsigned(half, a).bitwiseAND(F.lit((1 << (b - a)) - 1 if b - a < 64 else -1)) for a, b in zip(edges, edges[1:], strict=False)]
    return out


def find_near(queries: DataFrame, kinds: DataFrame, radius: int = 3) -> DataFrame:
    """queries(hi, lo), kinds(hi, lo, n), both distinct -> hi, lo, n_near: rows within the radius, its own included.

    A pair that several tables find counts in the first of them."""

    def tables(d: DataFrame, *more: str) -> DataFrame:
        return d.select("hi", "lo", *more, F.posexplode(F.array(*block_values(F.col("hi"), F.col("lo"), radius))).alias("block", "value"))

    q, k = tables(queries).alias("q"), tables(kinds, "n").alias("k")
    sides = [block_values(F.col(f"{s}.hi"), F.col(f"{s}.lo"), radius) for s in "qk"]
    first = F.coalesce(*[F.when(a == b, F.lit(i)) for i, (a, b) in enumerate(zip(*sides, strict=True))])
    near = distance(F.col("q.hi"), F.col("q.lo"), F.col("k.hi"), F.col("k.lo")) <= radius
    pairs = q.join(k, (F.col("q.block") == F.col("k.block")) & (F.col("q.value") == F.col("k.value")) & near & (first == F.col("q.block")))
    return pairs.groupBy("q.hi", "q.lo").agg(F.sum("k.n").alias("n_near"))


def bin_of(doc_id: Column, edges: list[int]) -> Column:
    """How many of the sorted edges an id has reached, found by groups of FAN; a null id comes after all."""
    groups = [edges[i : i + FAN] for i in range(0, len(edges), FAN)]
    if not groups:
        return F.when(doc_id.isNull(), 1).otherwise(0)
    longs = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    reached = lambda xs: F.size(F.filter(xs, lambda e: e <= doc_id))
    top = reached(longs([g[0] for g in groups]))
    inner = F.element_at(F.array(*[longs(g) for g in groups]), F.greatest(top, F.lit(1)))
    return F.when(doc_id.isNull(), len(edges) + 1).otherwise(F.when(top == 0, 0).otherwise((top - 1) * FAN + reached(inner)))


def with_next(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> bin, rn, next_bin, next_rn, doc_id, text, next_text, by ascending id (null last, ties by
    text); after the last comes the first. (bin, rn) is a row's place, and the rows of a bin lie in one partition.

    The ids' quantiles bound the bins, so one shuffle sorts the texts; the first row of a bin is dealt to the bin
    before as well, whose last row needs it."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = docs.select("doc_id").count()
    bins = min(MAX_BINS, n // BIN_ROWS)
    edges: list[int] = []
    if bins > 1:
        cuts = [i / bins for i in range(1, bins)]
        edges = sorted(set(docs.agg(F.percentile_approx("doc_id", cuts, 20 * bins)).first()[0] or []))
    placed = docs.withColumn("bin", bin_of(F.col("doc_id"), edges))
    all_bins = W.orderBy("bin")
    around = W.partitionBy()
    starts = placed.groupBy("bin").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("held"))
    starts = starts.withColumn("before", F.coalesce(F.lag("bin").over(all_bins), F.max("bin").over(around)))
    starts = starts.withColumn("next_bin", F.coalesce(F.lead("bin").over(all_bins), F.min("bin").over(around)))
    starts = staged(starts, "fingerprint-bins")  # MAX_BINS + 2 rows at most
    placed = placed.join(F.broadcast(starts), "bin")
    leads = F.col("doc_id").eqNullSafe(F.col("first_id"))
    dealt = F.posexplode(F.when(leads, F.array("bin", "before")).otherwise(F.array("bin"))).alias("guest", "at")
    placed = placed.select("doc_id", "text", "held", "next_bin", dealt)
    order = W.partitionBy("at").orderBy("guest", F.col("doc_id").asc_nulls_last(), "text")
    placed = placed.withColumn("rn", F.row_number().over(order)).withColumn("next_text", F.lead("text").over(order))
    last = F.col("rn") == F.col("held")
    return placed.where("guest = 0").select(
        F.col("at").alias("bin"),
        "rn",
        F.when(last, F.col("next_bin")).otherwise(F.col("at")).alias("next_bin"),
        F.when(last, F.lit(1)).otherwise(F.col("rn") + 1).alias("next_rn"),
        "doc_id",
        "text",
        "next_text",
    )


def edited(text: Column, following: Column) -> Column:
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.left(text, F.length(text) - half), F.left(following, half))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, likenesses, and for every fiftieth id the number of
    documents within 3 bits. Null, empty and wordless texts have fingerprint zero; a lone document is its own next one;
    null ids come after all others; rows of one id stand in the order of their texts, each a document; extra columns do not
    matter; an empty table gives an empty result; texts of any length count in chunks whose counters can't overflow."""
    rows = with_next(table(spark, sf_dir, "documents"))
    both = rows.select(
        "bin", "rn", "next_bin", "next_rn", "doc_id", F.length("text").alias("n_chars"),
        F.posexplode(F.array("text", edited(F.col("text"), F.col("next_text")))).alias("which", "text"),
    )
    both = both.withColumn("sha", F.when(F.col("which") == 1, F.sha2(F.col("text").cast("binary"), 256)).otherwise(""))
    both = both.withColumn("doc_id", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    keys = ["bin", "rn", "which", "next_bin", "next_rn", "doc_id", "n_chars", "sha"]
    found = staged(fingerprints(both, keys), "fingerprints").withColumn("doc_id", F.expr("try_cast(doc_id AS BIGINT)"))
    own = found.where("which = 0").alias("o")
    changed = found.where("which = 1").alias("e")
    follow = own.select(F.col("bin").alias("b"), F.col("rn").alias("r"), "hi", "lo").alias("f")
    out = own.join(changed, (F.col("o.bin") == F.col("e.bin")) & (F.col("o.rn") == F.col("e.rn")))
    out = out.join(follow, (F.col("o.next_bin") == F.col("b")) & (F.col("o.next_rn") == F.col("r")))
    half = lambda s: (F.col(f"{s}.hi"), F.col(f"{s}.lo"))
    kinds = own.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("n"))
    asked = own.where("doc_id % 50 = 0").select("hi", "lo").distinct()
    near = find_near(asked, kinds).alias("n")
    wanted = F.col("o.doc_id") % 50 == 0
    out = out.join(near, wanted & (F.col("o.hi") == F.col("n.hi")) & (F.col("o.lo") == F.col("n.lo")), "left")
    text = lambda hi, lo: F.lower(F.concat(F.lpad(F.hex(hi), 16, "0"), F.lpad(F.hex(lo), 16, "0")))
    return out.select(
        "o.doc_id",
        F.col("o.n_chars").cast("long").alias("n_chars"),
        F.col("e.sha").alias("edited_sha256"),
        text(*half("o")).alias("fingerprint"),
        text(*half("e")).alias("edited_fingerprint"),
        likeness(*half("o"), *half("e")).alias("near_edited"),
        likeness(*half("o"), *half("f")).alias("near_next"),
        F.col("n.n_near").alias("n_near"),
    )
