"""Operator 12: lines that many documents share are dropped, except in one document.

A line's key is hashed where the text is read; only (hash, document, position) rows move. They are range-partitioned by
hash and, inside a hash, by document and position, so that a line of a third of the corpus spreads over many ranges. A
task streams its sorted range: the first document of a hash keeps its lines, and as soon as enough documents are seen
the rest are dropped, with at most the first few documents of a hash at hand. Hashes at the edges of a range may go on
in the next one: their first few documents decide them in a small aggregation over all ranges.

What comes back to a document is a compressed bitmap of the lines that it keeps, not text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from studyloom.llm.common import lower_ascii, table
from studyloom.storage import staged

#: Code points of a key, and documents that hold it, from which on its lines are dropped; mean rows of a range.
MIN_CHARS, MIN_DOCS, RANGE_ROWS = 40, 5, 1 << 20
BLANKS = " \t\n\x0b\x0c\r"
FOUND = "h1 long, h2 long, doc_id long, text_hash long, pos int, edge boolean"


def lines_of(text: Column) -> Column:
    """The lines of a text; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def key_of(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def occurrences(docs: DataFrame, min_chars: int) -> DataFrame:
    """docs(doc_id, text) -> a row for each line whose key is long enough: 128 bits of its hash, document, position."""
    d = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.transform(lines_of(F.col("text")), key_of).alias("keys"))
    d = d.select("doc_id", "text_hash", F.posexplode("keys").alias("pos", "key")).where(F.length("key") >= min_chars)
    return d.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc_id", "text_hash", "pos")


class Stream:
    """One sorted range: hashes ascending, documents of a hash descending. Tells occurrences to drop, and those that the
    first and last hash of the range leave open."""

    def __init__(self, min_docs: int):
        self.least = min_docs
        self.hash: tuple[int, int] | None = None  # of the last row seen
        self.doc: tuple[int, bool] | None = None
        self.docs = 0  # documents of the running hash so far
        self.first = True  # the running hash is the range's first one
        self.held: list[pa.RecordBatch] = []  # rows of its first documents

    def feed(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        n = batch.num_rows
        if not n:
            return
        h1, h2 = (batch.column(i).to_numpy() for i in (0, 1))
        null = batch.column(2).is_null().to_numpy(zero_copy_only=False)
        doc = batch.column(2).fill_null(0).to_numpy()
        new_hash, new_doc = np.ones(n, bool), np.ones(n, bool)
        new_hash[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        new_hash[0] = self.hash != (h1[0], h2[0])
        new_doc[1:] = (doc[1:] != doc[:-1]) | (null[1:] != null[:-1])
        new_doc[0] = self.doc != (doc[0], null[0])
        new_doc |= new_hash
        seen = np.cumsum(new_doc)
        starts = np.flatnonzero(new_hash)
        run = np.cumsum(new_hash)  # 0: the hash that was running before
        before = np.concatenate(([-self.docs], seen[starts] - 1))
        number = seen - before[run]  # of the document inside its hash, from 1
        ends = np.concatenate((starts, [n])) - 1  # last row of run 0, 1, ...
        docs = np.where(ends >= 0, number[ends], self.docs)
        drop = number > self.least
        open_ = (number <= self.least) & (run == len(starts))  # the last hash goes on
        early = (number <= self.least) & (run < len(starts))
        if len(starts):  # the hash that was running has ended
            if self.hash is not None:
                yield from self.ended(batch.filter(pa.array(early & (run == 0))), int(docs[0]))
                drop |= early & (run > 0) & (docs[run] >= self.least) & (number > 1)
            else:  # run 1 is the range's first hash
                if len(starts) > 1:
                    yield marked(batch.filter(pa.array(early & (run == 1))), True)
                drop |= early & (run > 1) & (docs[run] >= self.least) & (number > 1)
            self.first = self.hash is None and len(starts) == 1
            self.held = []
        yield marked(batch.filter(pa.array(drop)), False)
        self.held.append(batch.filter(pa.array(open_)))
        self.hash, self.doc, self.docs = (h1[-1], h2[-1]), (doc[-1], null[-1]), int(docs[-1])

    def ended(self, more: pa.RecordBatch, docs: int) -> Iterator[pa.RecordBatch]:
        """The running hash ends inside the range, with so many documents in it."""
        for held in [*self.held, more]:
            if self.first:
                yield marked(held, True)
            elif docs >= self.least:
                yield marked(held.filter(pa.array(self.later(held))), False)

    def later(self, held: pa.RecordBatch) -> np.ndarray:
        """Rows of other documents than the hash's first one."""
        first = next(b.column(2)[0].as_py() for b in self.held if b.num_rows)
        ids = held.column(2).to_pylist()
        return np.fromiter((i != first for i in ids), bool, len(ids))

    def rest(self) -> Iterator[pa.RecordBatch]:
        for held in self.held:
            yield marked(held, True)


def marked(batch: pa.RecordBatch, edge: bool) -> pa.RecordBatch:
    return batch.append_column("edge", pa.array(np.full(batch.num_rows, edge)))


def dropped(found: DataFrame, min_docs: int) -> DataFrame:
    """occurrences -> doc_id, text_hash, pos of those to drop: of a hash that at least ``min_docs`` documents hold, all
    but the largest document's."""
    found = staged(found, "line-occurrences")
    by = [F.col("h1"), F.col("h2"), F.col("doc_id").desc_nulls_last(), F.col("text_hash"), F.col("pos")]
    ranges = max(1, -(-found.count() // RANGE_ROWS))
    line = found.repartitionByRange(ranges, *by).sortWithinPartitions(*by)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Stream(min_docs)
        for batch in batches:
            yield from state.feed(batch)
        yield from state.rest()

    told = staged(line.mapInArrow(stream, FOUND), "line-told")
    edge = told.where("edge")
    least = F.lit(-(1 << 63))  # stands for the null id, which comes after all others
    docs = edge.groupBy("h1", "h2", "doc_id").agg(F.count(F.lit(1)))
    docs = docs.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("docs"), F.max(F.coalesce("doc_id", least)).alias("largest"))
    open_ = edge.join(docs.where(F.col("docs") >= min_docs), ["h1", "h2"]).where(F.coalesce("doc_id", least) != F.col("largest"))
    return told.where("NOT edge").select("doc_id", "text_hash", "pos").union(open_.select("doc_id", "text_hash", "pos"))


def packed(positions: list[int]) -> bytes:
    keep = np.ones((max(positions) // 8 + 1) * 8, bool)  # whole bytes, their last bits set
    keep[positions] = False
    return zlib.compress(np.packbits(keep).tobytes())


@F.pandas_udf(BinaryType())
def pack(positions: pd.Series) -> pd.Series:
    return positions.map(packed)


def unpacked(bitmap: bytes, lines: int) -> np.ndarray:
    """A line's bit says that it stays; lines beyond the bitmap's end stay."""
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8)).astype(bool)[:lines]
    return np.concatenate((bits, np.ones(lines - len(bits), bool)))


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """docs(doc_id, text) -> doc_id, text_hash, n_dropped, keep: a row for each document that loses lines. ``keep`` is a
    zlib-compressed bitmap, first line in the highest bit, which ends with the last dropped line.

    Rows with one id are one document, and rows with null ids together another one, below all ids; which of their texts
    a row has, ``text_hash`` tells. Repeated lines of a document count once and stay or go together. Null and empty
    texts lose nothing."""

    rows = dropped(occurrences(docs, min_chars), min_docs)
    rows = rows.groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("gone"))
    return rows.select("doc_id", "text_hash", F.size("gone").cast("long").alias("n_dropped"), pack("gone").alias("keep"))


@F.pandas_udf(StringType())
def kept_text(text: pd.Series, keep: pd.Series) -> pd.Series:
    """A text without the lines that its bitmap drops; null where there is no bitmap, as nothing is dropped."""

    def one(t: str | None, bitmap: bytes | None) -> str | None:
        if bitmap is None or t is None:
            return None
        lines = t.split("\n")
        return "\n".join(line for line, stays in zip(lines, unpacked(bitmap, len(lines)), strict=True) if stays)

    return pd.Series([one(t, b) for t, b in zip(text, keep, strict=True)], dtype=object)


def deduplicated(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """docs(doc_id, text, ...) -> doc: the row as it is; kept: its text without the dropped lines; n_lines, n_dropped.

    Columns of any other names may stand in the rows, as they stay nested. No documents give no rows."""
    keep = keep_bitmaps(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), min_chars, min_docs)
    rows = docs.select(F.struct("*").alias("doc"), F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_hash"))
    rows = rows.join(keep, F.col("_id").eqNullSafe(keep["doc_id"]) & (F.col("_hash") == keep["text_hash"]), "left")
    text = F.coalesce("doc.text", F.lit(""))
    return rows.select(
        "doc",
        F.coalesce(kept_text(F.when(F.col("keep").isNotNull(), text), F.col("keep")), text).alias("kept"),
        F.size(lines_of(F.col("doc.text"))).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"),
    )


def op12_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines, dropped lines and the digest of what stays.

    Null and empty texts are one empty line; ids may be null or repeated (see ``keep_bitmaps``), repeated rows have equal
    results; ties need no order, as a line stays in one document with all its occurrences; extra columns do not matter;
    an empty table gives an empty result. Long texts move once, to meet their bitmap, and never as lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = deduplicated(docs)
    return out.select("doc.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT row, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
shared AS (SELECT key, max(doc_id) AS largest FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, coalesce(k.doc_id <> s.largest, false) AS gone FROM k LEFT JOIN shared s ON s.key = k.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM m GROUP BY row
"""
