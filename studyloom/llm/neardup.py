"""Operator 10: SimHash near-duplicates by sharded BK-trees.

Fingerprints at most ``radius`` bits apart agree in at least one of ``radius + 1`` blocks of bits. Every distinct
fingerprint goes to one shard per block, that of all fingerprints with its value there, and each shard is searched
through a BK-tree: children are keyed by their Hamming distance to the parent, and a search follows only the edges
within the radius of its own distance. A shard beyond ``TREE`` fingerprints is dealt to tiles, and each pair of
tiles is a shard of its own, so no tree and no task grows with a hot block. A shard hands on one edge per
fingerprint, to the least one that it reaches there, and connected components over the distinct fingerprints join
the shards' groups.

Trees are shuffled to where they are searched and not broadcast whole: all trees together grow with the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from studyloom.llm.common import small_batches, table
from studyloom.operators.components import connected_components
from studyloom.storage import discard, staged

BITS, SEED = 64, 42
#: Fingerprints of a tree at most (two tiles), rows of a batch of shards on average, queries searched at once.
TREE, BATCH_ROWS, QUERIES = 4096, 16384, 512
#: Shingles whose bits are counted at once.
VOTES = 1 << 16


def shingle_hashes(text: str, width: int) -> np.ndarray:
    """Hashes of the text's word shingles, repeats included; a shorter text is one shingle, no words are none."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = text.encode().lower().split()  # of bytes: A-Z only, and blank or \t to \r only
    if not words:
        return np.empty(0, dtype="<u8")
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([digest(joined, SEED)], dtype="<u8")
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1]).tolist()
    spans = zip(starts, ends[width - 1 :].tolist(), strict=False)
    return np.fromiter((digest(joined[a:b], SEED) for a, b in spans), dtype="<u8", count=len(words) - width + 1)


def fingerprint(text: str, width: int = 3) -> int:
    """64-bit SimHash of the text's word shingles, repeats included, as an unsigned integer; no words: 0."""
    return simhash(shingle_hashes(text, width))


def simhash(hashes: np.ndarray) -> int:
    """The bits that more than half of the hashes have; of no hashes: 0."""
    if not len(hashes):
        return 0
    votes = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), VOTES):
        part = hashes[i : i + VOTES].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view("<u8")[0])


@F.pandas_udf(T.LongType())
def _fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series(np.fromiter(map(fingerprint, texts), dtype=np.uint64, count=len(texts)).view(np.int64))


def fingerprints(text: Column) -> Column:
    """The fingerprint's 64 bits as a long; a null text is empty."""
    return _fingerprints(F.coalesce(text, F.lit("")))


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


class Forest:
    """BK-trees over the distinct fingerprints of several shards, one tree a shard, as flat arrays.

    All trees grow together: in each step every fingerprint still on its way stands at a node and looks at its
    distance to it; the first of those with one node and distance becomes that child, the others move on to it."""

    def __init__(self, shard: np.ndarray, fp: np.ndarray):
        n = len(fp)
        self.fp = fp
        self.root = np.zeros(n, dtype=np.int64)
        order = np.argsort(shard, kind="stable")
        first = np.flatnonzero(np.r_[True, shard[order][1:] != shard[order][:-1]])
        at = np.empty(n, dtype=np.int64)
        at[order] = np.repeat(order[first], np.diff(np.r_[first, n]))
        self.root = at.copy()
        edges = [np.empty((2, 0), dtype=np.int64)]
        going = np.flatnonzero(at != np.arange(n))
        while len(going):
            key = at[going] * (BITS + 1) + np.bitwise_count(fp[going] ^ fp[at[going]])
            keys, first, which = np.unique(key, return_index=True, return_inverse=True)
            child = going[first]
            edges.append(np.vstack([keys, child]))
            at[going] = child[which]
            going = going[at[going] != going]
        keys, child = np.hstack(edges)
        order = np.argsort(keys, kind="stable")
        self.keys, self.child = keys[order], child[order]

    def links(self, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Index pairs (a, b), a < b, of one shard within the radius: those of QUERIES fingerprints at a time, of
        which each has at most as many as there are fingerprints in its ball (2,080 at radius 2)."""
        for i in range(0, len(self.fp), QUERIES):
            query = np.arange(i, min(i + QUERIES, len(self.fp)))
            node = self.root[query]
            out = [np.empty((2, 0), dtype=np.int64)]
            while len(query):
                d = np.bitwise_count(self.fp[query] ^ self.fp[node]).astype(np.int64)
                hit = (d <= radius) & (query < node)
                out.append(np.vstack([query[hit], node[hit]]))
                base = node * (BITS + 1)
                low = np.searchsorted(self.keys, base + np.maximum(d - radius, 0), "left")
                high = np.searchsorted(self.keys, base + np.minimum(d + radius, BITS), "right")
                n = high - low
                query = np.repeat(query, n)
                node = self.child[np.repeat(low - np.cumsum(n) + n, n) + np.arange(len(query))]
            yield tuple(np.hstack(out))

    def nearest(self, radius: int) -> np.ndarray:
        """For each fingerprint the index of the nearest of those before it in its shard, within the radius, the first
        of equally near ones; -1 without any."""
        to, far = np.full(len(self.fp), -1), np.full(len(self.fp), radius + 1)
        for a, b in self.links(radius):
            d = np.bitwise_count(self.fp[a] ^ self.fp[b]).astype(np.int64)
            order = np.lexsort((a, d, b))
            b, first = np.unique(b[order], return_index=True)
            a, d = a[order][first], d[order][first]
            new = d < far[b]
            to[b[new]], far[b[new]] = a[new], d[new]
        return to

    def groups(self, radius: int) -> np.ndarray:
        """For each fingerprint the index of the least that a chain of links reaches. Links are folded into the
        groups as they are found, so they are never held together."""
        nodes = np.arange(len(self.fp))
        rank = self.fp.view(np.int64)
        to = nodes
        for a, b in self.links(radius):
            if len(a):
                to = least_reached(len(nodes), np.r_[a, nodes], np.r_[b, to], rank)
        return to


def least_reached(n: int, a: np.ndarray, b: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For nodes 0 to n - 1 and edges (a, b): the node of lowest rank that each reaches."""
    by_rank = np.argsort(rank)
    label = np.empty(n, dtype=np.int64)
    label[by_rank] = np.arange(n)
    while True:
        before = label.copy()
        np.minimum.at(label, a, before[b])
        np.minimum.at(label, b, before[a])
        label = label[by_rank[label]]  # jump to the label of the label's node
        if np.array_equal(label, before):
            return by_rank[label]


def _search(radius: int):
    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        shard = pdf.groupby(["block", "value", "i", "j"], sort=False).ngroup().to_numpy()
        fp = pdf["fp"].to_numpy().view(np.uint64)
        signed = fp.view(np.int64)
        to = signed[Forest(shard, fp).groups(radius)]
        out = pd.DataFrame({"a": signed, "b": to})
        return out[out.a != out.b].drop_duplicates()

    return search


def block_values(fp: Column, radius: int) -> list[Column]:
    """The radius + 1 blocks of a 64-bit fingerprint, each as a long."""
    edges = [BITS * k // (radius + 1) for k in range(radius + 2)]
    return [F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)) for lo, hi in zip(edges, edges[1:], strict=False)]


def shards(distinct: DataFrame, radius: int, tree: int = TREE) -> DataFrame:
    """distinct(fp) -> fp, block, value, i, j: a row for each shard of two or more that a fingerprint goes to."""
    tile_rows = tree // 2
    rows = distinct.select("fp", F.posexplode(F.array(*block_values(F.col("fp"), radius))).alias("block", "value"))
    held = rows.groupBy("block", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = rows.join(held, ["block", "value"])
    tiles = F.when(F.col("n") <= tree, F.lit(1)).otherwise(F.ceil(F.col("n") / tile_rows)).cast("int")
    rows = rows.withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    return rows.select("fp", "block", "value", "tile", others).select(
        "fp", "block", "value", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j")
    )


def near_groups(distinct: DataFrame, radius: int = 2, tree: int = TREE) -> DataFrame:
    """distinct(fp) -> node, component: the fingerprints with a neighbour, by the least that they reach."""
    rows = staged(shards(distinct, radius, tree), "simhash-shards")
    batches = max(1, rows.count() // BATCH_ROWS)
    batch = F.pmod(F.xxhash64("block", "value", "i", "j"), F.lit(batches)).alias("batch")
    edges = rows.groupBy(batch).applyInPandas(_search(radius), "a long, b long")
    return connected_components(edges)


def near_duplicates(docs: DataFrame, radius: int = 2, tree: int = TREE) -> DataFrame:
    """docs(doc_id, fp) -> doc_id, fp, component_id: the smallest id that a chain of links reaches.

    Rows of one fingerprint are linked, empty texts too. A repeated row gets the same answer; a null id is never
    the smallest unless a group has no other; an empty table gives an empty result."""
    kinds = staged(docs.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-kinds")
    groups = near_groups(kinds.select("fp"), radius, tree)
    kinds = kinds.join(groups, kinds.fp == groups.node, "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    least = kinds.groupBy("component").agg(F.min("least").alias("component_id"))
    kinds = kinds.join(least, "component").select("fp", "component_id")
    return docs.join(kinds, "fp").select("doc_id", "fp", "component_id")


def fingerprinted(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> doc_id, fp; computed once and staged."""
    return staged(docs.select("doc_id", fingerprints(F.col("text")).alias("fp")), "simhash-docs")


def op10_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    out = near_duplicates(fingerprinted(table(spark, sf_dir, "documents")))
    return out.select("doc_id", hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each group of near copies: that of the smallest id, null ids last, then the smallest n_chars. Groups
    are those of five-word shingles shared at 0.8 or more (``overlap``): BK-trees are searched with fingerprints of five
    words, what they link is decided exactly, and links that no tree has told are found by exact means.

    Rows are chosen, not ids: of rows that repeat an id with different texts each stays or goes with its own group,
    and of near copies without an id one stays only if no copy has one. Null and empty texts are one group; all columns
    stay as they are, whatever their names; no documents give no documents."""
    from studyloom.llm import overlap

    rows = overlap.sketched(docs)
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "n_chars", "kind", "row")).alias("best")
    kept = staged(overlap.with_components(rows).groupBy("component").agg(best).select("best.row"), "overlap-kept")
    out = staged(rows.join(overlap.small(kept), "row").select("doc.*"), "overlap-out")
    discard(rows)
    return out
