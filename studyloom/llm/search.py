"""Operator 13: exact ranked lexical search by geometric blocks of posting lists.

Texts become vectors over the terms that are asked for, and the statistics of the score come from all of them. The
vectors are read in shards of bounded size. In a shard a term's posting list is clustered by the documents' likeness
into blocks, and a block stores the coordinatewise maximum of its documents over the terms that some item asks for
together with this one. An item walks the lists of its dearest terms: a block whose maxima, weighted, stay below the
item's fiftieth score so far is skipped; every other document is scored exactly. Lists of cheap terms are left out as
soon as all of them together stay below it. No bound is an estimate, so that the result is that of scoring everything.

A task keeps fifty rows an item over all its shards; the tasks' rows are ranked in two steps.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from studyloom.llm.common import table
from studyloom.storage import staged

#: Rows of a result; documents of a block on average; numbers (documents times terms) of a shard's matrix; dimensions of
#: the projection in which documents are likened; how many parts rank an item's rows first.
TOP, BLOCK_DOCS, SHARD_CELLS, SKETCH, SALT = 50, 64, 1 << 24, 32, 64
#: Terms of all items that are sought in one pass over the texts; further items take further passes.
WAVE_TERMS = 1 << 16
#: Separators become blanks, A-Z lower-case, and all else stays: a term's bytes are letters, digits and what isn't ASCII.
FOLD = bytes((b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32) for b in range(256))
VECTORS = "doc_id long, n int, terms array<int>, counts array<int>"
ROWS = "item int, item_id long, doc_id long, score long"


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


def vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """docs(doc_id, text) -> a row for each document with a term at all: n, its terms of the vocabulary, their counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, n, terms, counts, ends = [], [], [], [], [0]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = terms_of(text.as_py())
                if not words:
                    continue
                asked = [i for i in map(vocabulary.get, words) if i is not None]
                at, tf = np.unique(np.array(asked, np.int32), return_counts=True)
                ids.append(doc_id)
                n.append(len(words))
                terms.append(at)
                counts.append(tf.astype(np.int32))
                ends.append(ends[-1] + len(at))
            flat = lambda xs: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *xs])))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int32()), flat(terms), flat(counts)], names=["doc_id", "n", "terms", "counts"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(count, VECTORS)


class Statistics(NamedTuple):
    documents: int
    length: int  # terms of all documents
    weights: np.ndarray  # by term; 0 for terms that no document holds


def statistics(found: DataFrame, terms: int) -> Statistics:
    """Of all vectors; a row for each asked term comes to the driver, WAVE_TERMS or one item's at most."""
    n, length = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.zeros(terms, np.int64)
    for term, df in found.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        weights[term] = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
    return Statistics(n, length, weights)


def partners(items: list[np.ndarray], terms: int) -> list[np.ndarray]:
    """For each term, the terms that some item asks for together with it, sorted: coordinates of its summaries."""
    out: list[list[np.ndarray]] = [[] for _ in range(terms)]
    for asked in items:
        for t in asked:
            out[t].append(asked)
    return [np.unique(np.concatenate([np.zeros(0, np.int64), *x])) for x in out]


class Block(NamedTuple):
    docs: np.ndarray  # rows of the shard's matrix, all lists' blocks one after the other
    starts: np.ndarray
    maxima: np.ndarray  # blocks by partner terms


class Shard:
    """Documents as a matrix of term parts (before weights), and blocks of its posting lists, made when first read."""

    def __init__(self, doc_id: np.ndarray, n: np.ndarray, rows: np.ndarray, terms: np.ndarray, counts: np.ndarray, stats: Statistics):
        self.doc_id = doc_id
        m = 50 + (50 * n.astype(np.int64) * stats.documents) // stats.length
        tf = counts.astype(np.int64)
        part = (1_000_000_000 * tf) // (1000 * tf + 20 * m[rows])
        self.parts = np.zeros((len(doc_id), len(stats.weights)), np.int32)
        self.parts[rows, terms] = part
        self.most = self.parts.max(axis=0, initial=0).astype(np.int64) * stats.weights
        signs = np.random.default_rng(0).choice(np.array([-1, 1], np.float32), (len(stats.weights), SKETCH))
        heavy = (part * stats.weights[terms]).astype(np.float32)
        sketch = np.zeros((len(doc_id), SKETCH), np.float32)
        np.add.at(sketch, rows, heavy[:, None] * signs[terms])
        self.sketch = sketch / np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1e-9)
        self.lists: dict[int, Block] = {}

    def blocks(self, term: int, partners: np.ndarray) -> Block:
        """The term's posting list around evenly spaced documents of its own, each document with the likest of them."""
        if term not in self.lists:
            docs = np.flatnonzero(self.parts[:, term])
            seeds = docs[:: BLOCK_DOCS]
            home = np.argmax(self.sketch[docs] @ self.sketch[seeds].T, axis=1)
            order = np.argsort(home, kind="stable")
            docs, home = docs[order], home[order]
            starts = np.flatnonzero(np.concatenate(([True], home[1:] != home[:-1])))
            maxima = np.maximum.reduceat(self.parts[np.ix_(docs, partners)], starts, axis=0)
            self.lists[term] = Block(docs, np.append(starts, len(docs)), maxima)
        return self.lists[term]


class Best:
    """An item's best rows so far: by score, then ascending id, null last."""

    def __init__(self, top: int):
        self.top, self.score, self.doc, self.null = top, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def least(self) -> int:
        """A score below this one can't be among the best."""
        return int(self.score[-1]) if len(self.score) >= self.top else 1

    def add(self, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        good = score >= self.least
        score, doc, null = (np.concatenate(x) for x in ((self.score, score[good]), (self.doc, doc[good]), (self.null, null[good])))
        order = np.lexsort((doc, null, -score))[: self.top]
        self.score, self.doc, self.null = score[order], doc[order], null[order]


def walk(shard: Shard, null: np.ndarray, asked: np.ndarray, weights: np.ndarray, coordinates: list[np.ndarray], best: Best) -> None:
    """Adds the shard's documents that are among an item's best."""
    asked = asked[shard.most[asked] > 0]
    asked = asked[np.argsort(-shard.most[asked], kind="stable")]
    rest = np.cumsum(shard.most[asked][::-1])[::-1]  # what a document of this list and later ones alone can reach
    done = np.zeros(len(shard.doc_id), bool)
    w = weights[asked]
    for term, reach in zip(asked, rest, strict=True):
        if reach < best.least:
            break
        block = shard.blocks(int(term), coordinates[term])
        at = np.searchsorted(coordinates[term], asked)
        bound = block.maxima[:, at].astype(np.int64) @ w
        for b in np.argsort(-bound, kind="stable"):
            if bound[b] < best.least:
                break
            docs = block.docs[block.starts[b] : block.starts[b + 1]]
            docs = docs[~done[docs]]
            if len(docs):
                done[docs] = True
                best.add(shard.parts[np.ix_(docs, asked)].astype(np.int64) @ w, shard.doc_id[docs], null[docs])


def best_of(found: DataFrame, items: list[np.ndarray], item_ids: list[int | None], stats: Statistics, top: int) -> DataFrame:
    """The best rows of each task's documents: item (its place in the list), item_id, doc_id, score."""
    coordinates = partners(items, len(stats.weights))
    size = max(BLOCK_DOCS, SHARD_CELLS // max(1, len(stats.weights)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(top) for _ in items]
        for part in shards(batches, size):
            null = part.column(0).is_null().to_numpy(zero_copy_only=False)
            ends = part.column(2).value_lengths().to_numpy(zero_copy_only=False)
            rows = np.repeat(np.arange(part.num_rows), ends)
            flat = lambda i: part.column(i).flatten().to_numpy(zero_copy_only=False)  # noqa: E731, B023
            shard = Shard(part.column(0).fill_null(0).to_numpy(), part.column(1).to_numpy(), rows, flat(2), flat(3), stats)
            for asked, b in zip(items, best, strict=True):
                walk(shard, null, asked, stats.weights, coordinates, b)
        for item, (item_id, b) in enumerate(zip(item_ids, best, strict=True)):
            n = len(b.score)
            columns = [pa.array(np.full(n, item, np.int32)), pa.array([item_id] * n, pa.int64()), pa.array(b.doc, mask=b.null), pa.array(b.score)]
            yield pa.RecordBatch.from_arrays(columns, names=["item", "item_id", "doc_id", "score"])

    return found.mapInArrow(search, ROWS)


def shards(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Batches of exactly ``size`` rows, but for the last one."""
    held, rows = [], 0
    for batch in batches:
        while batch.num_rows:
            held.append(batch.slice(0, size - rows))
            rows += held[-1].num_rows
            batch = batch.slice(held[-1].num_rows)
            if rows == size:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, rows = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def waves(items: DataFrame) -> Iterator[list[tuple[int, list[bytes]]]]:
    """(item_id, distinct terms) of all items in waves of at most WAVE_TERMS terms, or one item. Items come to the driver one
    partition after the other and are not held beyond their wave."""
    wave: list[tuple[int, list[bytes]]] = []
    held = 0
    for row in items.select("item_id", "text").toLocalIterator():
        terms = sorted(set(terms_of(row.text)))
        if wave and held + len(terms) > WAVE_TERMS:
            yield wave
            wave, held = [], 0
        if terms:
            wave.append((row.item_id, terms))
            held += len(terms)
    if wave:
        yield wave


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """docs(doc_id, text), items(item_id, text) -> item_id, rank, doc_id, score: each item's best documents.

    Null, empty and wordless texts hold no term: such documents count nowhere, such items find nothing. A null document
    id ranks after others of its score; repeated rows of documents rank each by itself; each row of items is an item,
    also where ids repeat or are null. Fewer documents than ``top`` with a score above 0 give fewer rows."""
    spark = docs.sparkSession
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for wave in waves(items):
        vocabulary = {t: i for i, t in enumerate(sorted({t for _, terms in wave for t in terms}))}
        asked = [np.array(sorted(vocabulary[t] for t in terms), np.int64) for _, terms in wave]
        found = staged(vectors(docs, vocabulary), "search-vectors")
        rows = best_of(found, asked, [item_id for item_id, _ in wave], statistics(found, len(vocabulary)), top)
        order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
        rows = rows.withColumn("part", F.spark_partition_id() % SALT)
        for keys in (["item", "part"], ["item"]):
            rows = rows.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
        out = out.union(staged(rows.select("item_id", "rank", "doc_id", "score"), "search-rows"))
    return out


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty best documents of each benchmark item.

    Nulls, empty texts, repeated rows and ties as in ``ranked``; long texts are whole; extra columns do not matter; an
    empty table on either side gives an empty result."""
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
i AS (SELECT row_number() OVER () AS item, item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM benchmark),
q AS (SELECT DISTINCT item, item_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM i),
tf AS (SELECT row, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM d GROUP BY row, term),
len AS (SELECT row, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY row),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS len FROM len),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY term, docs),
m AS (SELECT row, 50 + (50 * n * docs) // len AS m FROM len, total),
s AS (SELECT item, any_value(item_id) AS item_id, row, any_value(doc_id) AS doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
 FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (row) GROUP BY item, row),
r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 50
"""
