"""Near copies for the pipeline: texts of which 0.8 or more of the five-word shingles are shared (Jaccard).

Texts of one shingle set are one kind. As in operator 10, a kind has the SimHash of its shingles, and BK-trees over shards
are searched within a radius. Sets at 0.8 are some ten of 64 bits apart, too wide for shards of equal bits; so the shards are
buckets of MinHash: a kind goes to BANDS buckets, each the hash of
ROWS minima, and two kinds at similarity s share one with probability 1 - (1 - s ** ROWS) ** BANDS, 0.99993 at 0.8.
Every candidate is decided by the exact overlap of the two shingle sets, and links are joined to components. A tree
gives each of its members the nearest of those before it; links that no tree has told are found below, exactly.

Two sets have at most as many shingles in common as either has that any other candidate holds too. Those counts, one a set,
rule out members whose own words alone keep them below 0.8 of every other of their bucket, before any comparison.

After the trees a bucket compares its members with one leader, that with the most company in all its buckets, twice over; then
every two members that no chain of links has joined yet, whose counts and parities allow it, and that share one of their
rarest shingles. Of two sets that share 0.8 or more, each set's rarest fifth and one more (in one order of all shingles) have a
shingle in common, so that leaves out no link. A large group of near copies costs a comparison each and not one for each
pair, texts that only share a common passage are not compared, and still no link is lost: those not compared are in one
component anyhow, or cannot be alike.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from studyloom.llm.neardup import BATCH_ROWS, Forest, shingle_hashes, simhash
from studyloom.operators.components import connected_components
from studyloom.storage import discard, staged

#: Words of a shingle; the least similarity is LEAST[0] / LEAST[1].
WIDTH, LEAST = 5, (4, 5)
BANDS, ROWS = 24, 5
#: Bits within which trees are searched (five standard deviations beyond the mean at 0.8; of unlike sets one pair in thirty is
#: as near); members of a tree on average at most, a larger bucket has several.
RADIUS, TREE = 24, 1024
#: Turns in which a bucket's members meet its leader only; pairs of a leader that one task gets on average, and meetings by a
#: shingle that one task looks at.
LEADS, PART_PAIRS, PART_MEETINGS = 2, 2000, 1 << 20
#: Rows of numbers that may be broadcast, some 64 MB; beyond it the larger side is shuffled.
BROADCAST_ROWS = 2_000_000
#: Bits of a set's parities, and how many of them make one of the short parities.
PARITIES, FOLDED = 4096, 8
#: Shingles hashed at once by all functions.
HASHED = 1 << 12
SKETCH = T.StructType().add("kind", T.BinaryType()).add("size", T.IntegerType()).add("fp", T.LongType()).add("buckets", T.ArrayType(T.LongType()))
_RANDOM = np.random.default_rng(42)
_XORS = _RANDOM.integers(0, 1 << 64, (BANDS * ROWS, 1), dtype=np.uint64)
_ODDS = _RANDOM.integers(0, 1 << 64, (BANDS * ROWS, 1), dtype=np.uint64) | np.uint64(1)


def shingles(text: str) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles; a shorter text is one shingle, no words are none."""
    return np.unique(shingle_hashes(text, WIDTH))


def buckets(hashes: np.ndarray) -> np.ndarray:
    """The BANDS buckets of a shingle set; an empty set has none."""
    if not len(hashes):
        return np.empty(0, dtype=np.int64)
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(hashes), HASHED):
        np.minimum(low, ((hashes[i : i + HASHED] ^ _XORS) * _ODDS).min(axis=1), out=low)
    h = np.arange(BANDS, dtype=np.uint64)
    for row in low.reshape(BANDS, ROWS).T:
        h = (h ^ (h >> np.uint64(29)) ^ row) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return h.view(np.int64)


@F.pandas_udf(SKETCH)
def _sketches(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        sets = [shingles(t) for t in texts]
        kinds = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
        fps = np.fromiter(map(simhash, sets), dtype=np.uint64, count=len(sets)).view(np.int64)
        yield pd.DataFrame({"kind": kinds, "size": [len(s) for s in sets], "fp": fps, "buckets": [buckets(s) for s in sets]})


@F.pandas_udf(T.BinaryType())
def _sets(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([shingles(t).tobytes() for t in texts], dtype=object)


@F.pandas_udf(T.ArrayType(T.LongType()))
def _hashes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for sets in batches:
        yield pd.Series([np.frombuffer(x, dtype=np.int64) for x in sets], dtype=object)


@F.pandas_udf(T.ArrayType(T.LongType()))
def _parities(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for sets in batches:
        yield pd.Series([parities(np.frombuffer(x, dtype=np.uint64)) for x in sets], dtype=object)


@F.pandas_udf(T.BooleanType())
def _alike(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for xs, ys in batches:
        yield pd.Series([alike(np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)) for x, y in zip(xs, ys, strict=True)], dtype=bool)


def parities(hashes: np.ndarray) -> np.ndarray:
    """PARITIES bits, each the parity of the shingles dealt to it: a shingle that one of two sets has flips one bit, so
    that two sets differ in at least as many shingles as their bits do."""
    n = np.bincount((hashes % np.uint64(PARITIES)).astype(np.int64), minlength=PARITIES)
    return np.packbits((n & 1).astype(np.uint8)).view(np.int64)


def alike(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both * LEAST[1] >= (len(x) + len(y) - both) * LEAST[0]


def sketched(docs: DataFrame) -> DataFrame:
    """docs(text, ...) -> row, doc (all columns), kind, size, fp, buckets; staged, so that a row keeps its number."""
    found = docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc"), _sketches(F.coalesce("text", F.lit(""))).alias("s"))
    return staged(found.select("row", "doc", "s.*"), "overlap-docs")


def small(numbers: DataFrame) -> DataFrame:
    """A staged table of numbers, to be broadcast if its size allows that."""
    return F.broadcast(numbers) if numbers.count() <= BROADCAST_ROWS else numbers


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs(a, b) -> those alike. The pairs of a frequent b are dealt to several tasks."""
    held = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / PART_PAIRS).alias("parts"))
    dealt = staged(pairs.join(held, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("parts")).alias("part")), "overlap-dealt")
    once = staged(dealt.select("b", "part").distinct(), "overlap-dealt")
    left = sets.select(F.col("node").alias("a"), F.col("set").alias("a_set")).join(small(dealt), "a")
    right = sets.select(F.col("node").alias("b"), F.col("set").alias("b_set")).join(small(once), "b")
    return left.join(right, ["b", "part"]).where(_alike("a_set", "b_set")).select("a", "b")


def _search(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("node")
    node, fp = pdf["node"].to_numpy(), pdf["fp"].to_numpy().view(np.uint64)
    to = Forest(pdf.groupby(["bucket", "part"], sort=False).ngroup().to_numpy(), fp).nearest(RADIUS)
    return pd.DataFrame({"a": node[to >= 0], "b": node[to[to >= 0]]}).drop_duplicates()


def _by_trees(members: DataFrame) -> DataFrame:
    """members(bucket, node, fp, ...) -> pairs(a, b): each node with the nearest of the lesser nodes of its bucket, by a BK-tree for each
    bucket, and for each part of a large one."""
    held = members.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / TREE).alias("parts"))
    rows = staged(members.join(held, "bucket").select("bucket", "node", "fp", F.pmod(F.xxhash64("node"), F.col("parts")).alias("part")), "overlap-trees")
    batch = F.pmod(F.xxhash64("bucket", "part"), F.lit(max(1, rows.count() // BATCH_ROWS))).alias("batch")
    return rows.groupBy(batch).applyInPandas(_search, "a long, b long").distinct()


def _rarest(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """nodes(node) -> node, rare: the shingles that a set alike must have one of, less those of no other node."""
    own = sets.join(small(nodes), "node").select("node", F.explode(_hashes("set")).alias("h"))
    own = staged(own, "overlap-shingles")
    held = own.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    ordered = own.join(held, "h").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("n", "h"))).alias("o"))
    size = F.size("o")
    first = F.slice("o", F.lit(1), (size - F.ceil(size * LEAST[0] / F.lit(LEAST[1])) + 1).cast("int"))
    return ordered.select("node", F.transform(F.filter(first, lambda x: x["n"] > 1), lambda x: x["h"]).alias("rare"))


def _held(sets: DataFrame) -> DataFrame:
    """sets(node, set) -> node, alone: how many of its shingles no other node has; nodes with none do not appear."""
    own = sets.select("node", F.explode(_hashes("set")).alias("h"))
    single = own.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node")).where("n = 1")
    return single.groupBy("node").agg(F.count(F.lit(1)).cast("int").alias("alone"))


def _fits(a_held: Column, b_held: Column, sizes: Column) -> Column:
    """Sets of that many held shingles, their sizes added, can be alike."""
    return F.least(a_held, b_held) * (LEAST[0] + LEAST[1]) >= sizes * LEAST[0]


def _near(a: Column, b: Column, sizes: Column) -> Column:
    """Sets of those parities, their sizes added, can be alike."""
    differ = F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    return differ * (LEAST[0] + LEAST[1]) <= sizes * (LEAST[1] - LEAST[0])


def _hopeful(members: DataFrame) -> DataFrame:
    """members(bucket, size, held, ...) less those that can be alike to no set as large as the least of their bucket, nor
    to one as small as a set alike may be."""
    low = members.groupBy("bucket").agg(F.min("size").alias("low"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    other = F.greatest(F.col("low"), F.ceil(F.col("size") * LEAST[0] / F.lit(LEAST[1])))
    return members.join(low, "bucket").where(_fits(F.col("held"), F.col("held"), F.col("size") + other)).drop("low")


def _folded(parities: Column) -> list[Column]:
    """The parities of FOLDED times fewer bins, of which each takes those that agree modulo their number, as longs."""
    n = PARITIES // 64 // FOLDED
    out = []
    for i in range(n):
        c = F.get(parities, F.lit(i))
        for j in range(1, FOLDED):
            c = c.bitwiseXOR(F.get(parities, F.lit(i + j * n)))
        out.append(c.alias(f"p{i}"))
    return out


def _sides(rare: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rare(h, node, label, ...) -> the rows that look for partners and those that they look at, with the part of a shingle in which they
    meet. Only rows of another label than the one that most of a shingle's rows have look for partners, so that the members of a
    large component never meet each other; a shingle of many meetings has several parts."""
    own = rare.groupBy("h", "label").agg(F.count(F.lit(1)).alias("k"))
    top = own.groupBy("h").agg(F.max_by("label", F.struct("k", "label")).alias("top"), F.max("k").alias("k"), F.sum("k").alias("n"))
    minor = F.col("n") - F.col("k")
    parts = F.least(minor, F.ceil(minor * F.col("n") / PART_MEETINGS)).cast("int")
    d = rare.join(top.where("n > k").select("h", "top", parts.alias("parts")), "h")
    one = d.where("label <> top").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts").cast("long")).cast("int"))
    return one, d.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))


def _met(rare: DataFrame) -> DataFrame:
    """rare(h, node, label, ...) -> pairs (l, r) of rows with one h and different labels, each pair once for each h."""
    one, all_ = _sides(rare)
    met = one.alias("l").join(all_.alias("r"), (F.col("l.h") == F.col("r.h")) & (F.col("l.part") == F.col("r.part")) & (F.col("l.label") != F.col("r.label")))
    return met.where((F.col("r.label") == F.col("r.top")) | (F.col("l.node") < F.col("r.node")))


def _by_rarest(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """nodes(node, label, size, held) -> pairs(a, b) of different labels that can be alike. They meet by a shared rarest shingle; counts and folded
    parities, which are short enough to go with every shingle, rule pairs out where they meet, and all parities once for each
    pair that is left."""
    marks = staged(sets.join(small(nodes.select("node")), "node").select("node", _parities("set").alias("parities")), "overlap-marks")
    short = [c for c in _folded(F.col("parities"))]
    keyed = nodes.join(_rarest(nodes.select("node"), sets), "node").join(marks.select("node", *short), "node")
    names = [f"p{i}" for i in range(len(short))]
    both = _met(staged(keyed.select("node", "label", "size", "held", *names, F.explode("rare").alias("h")), "overlap-rare"))
    sizes = F.col("l.size") + F.col("r.size")
    differ = sum((F.bit_count(F.col(f"l.{p}").bitwiseXOR(F.col(f"r.{p}"))) for p in names), F.lit(0))
    hope = _fits(F.col("l.held"), F.col("r.held"), sizes) & (differ * (LEAST[0] + LEAST[1]) <= sizes * (LEAST[1] - LEAST[0]))
    met = both.where(hope).select(F.greatest("l.node", "r.node").alias("a"), F.least("l.node", "r.node").alias("b"), sizes.alias("sizes"))
    met = staged(met.distinct(), "overlap-met")
    side = lambda c: marks.select(F.col("node").alias(c), F.col("parities").alias(f"{c}_parities"))
    return met.join(side("a"), "a").join(side("b"), "b").where(_near(F.col("a_parities"), F.col("b_parities"), F.col("sizes"))).select("a", "b")


def with_components(rows: DataFrame) -> DataFrame:
    """rows of ``sketched`` -> row, doc_id, n_chars, kind, component: the least row that a chain of links reaches."""
    kinds = staged(rows.groupBy("kind").agg(F.min("row").alias("node")), "overlap-kinds")
    own = rows.join(small(kinds.select(F.col("node").alias("row"))), "row").select(F.col("row").alias("node"), "size", "fp", F.explode("buckets").alias("bucket"))
    own = staged(own, "overlap-buckets")
    shared = own.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = staged(own.join(shared, "bucket"), "overlap-members")
    discard(own)
    nodes = staged(members.select("node").distinct(), "overlap-nodes")
    sets = staged(rows.join(small(nodes.select(F.col("node").alias("row"))), "row").select(F.col("row").alias("node"), _sets(F.coalesce("doc.text", F.lit(""))).alias("set")), "overlap-sets")
    alone = staged(_held(sets), "overlap-held")
    held = F.col("size") - F.coalesce("alone", F.lit(0))
    members = staged(_hopeful(members.drop("n").join(small(alone), "node", "left").select("bucket", "node", "size", "fp", held.alias("held"))), "overlap-hopeful")
    members = _hopeful(members)  # once more, without those that have gone
    crowd = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = staged(members.join(crowd, "bucket"), "overlap-members")
    links = staged(_verified(staged(_by_trees(members), "overlap-pairs"), sets), "overlap-links")
    labels = staged(connected_components(links), "overlap-labels")
    company = staged(members.groupBy("node").agg(F.sum("n").alias("company")), "overlap-company")
    members = staged(members.join(small(company), "node").select("bucket", "node", "size", "held", "company"), "overlap-members")

    labelled = lambda d, found: d.join(found, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")
    rest = members
    for turn in range(LEADS + 1):
        if turn < LEADS:
            rest = labelled(rest.select(*members.columns), labels)
            lead = rest.groupBy("bucket").agg(F.max_by(F.struct("node", "label", "size", "held"), F.struct("company", -F.col("node"))).alias("lead"), F.count(F.lit(1)).alias("n"))
            rest = staged(rest.join(lead.where("n > 1"), "bucket").where("label != lead.label"), "overlap-rest")
            pairs = rest.where(_fits(F.col("held"), F.col("lead.held"), F.col("size") + F.col("lead.size"))).select(F.col("node").alias("a"), F.col("lead.node").alias("b"))
        else:
            every = labelled(members, labels)
            mixed = every.groupBy("bucket").agg(F.min("label").alias("l"), F.max("label").alias("m")).where("l != m").select("bucket")
            every = staged(every.join(mixed, "bucket"), "overlap-mixed")
            nodes = staged(every.select("node", "label", "size", "held").distinct(), "overlap-nodes")
            pairs = _by_rarest(nodes, sets)
        pairs = staged(pairs.distinct(), "overlap-pairs")
        if pairs.isEmpty():
            continue
        found = staged(_verified(pairs, sets), "overlap-links")
        links = links.union(found)
        labels = staged(connected_components(links), "overlap-labels")
        if turn < LEADS:
            # those that the leader has not gained, even by a chain, go on
            rest = labelled(rest.drop("label"), labels).join(labels.select(F.col("node").alias("at"), F.col("component").alias("to")), F.col("lead.node") == F.col("at"), "left")
            rest = staged(rest.where("label != coalesce(to, lead.node)").select(*members.columns), "overlap-next")
    discard(sets)
    placed = rows.select("row", "doc.doc_id", "doc.n_chars", "kind").join(kinds, "kind").join(labels, "node", "left")
    return placed.select("row", "doc_id", "n_chars", "kind", F.coalesce("component", "node").alias("component"))
