"""Operator 8: byte-level BPE encoding by monoid tree reduction, and decoding.

A span of text is encoded as two halves, recursively down to short leaves. Two neighbours are joined by encoding
anew a window around the cut between them, which grows until the tokens outside it are proven final. The proof: no
match of the split pattern holds a non-blank followed by a blank, so such a place ends one match and begins another
whatever else the text holds, and merges never cross matches. A window that ends at such places, or at the ends of
the span, leaves every token beyond as it is. Decoding concatenates the tokens' bytes, again up the tree.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studyloom.llm.common import small_batches, table

#: Characters of a leaf, which the library encodes, and tokens of a leaf of decoding. Most texts are several of them.
LEAF, DECODE_LEAF = 512, 256
#: The characters with Unicode's White_Space property, the split pattern's \s. Fixed values.
BLANKS = frozenset(map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))

LONG_BLANKS = 10000
LONG_RUN = re.compile(f"[{''.join(BLANKS)}]{{{LONG_BLANKS},}}")


class Coder:
    """Encoder and decoder of one rank file; ``pattern`` splits a text before the merges."""

    def __init__(self, ranks_path: str, pattern: str, leaf: int = LEAF):
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.leaf = leaf
        self.core = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.width = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, i in ranks.items():
            self.width[i] = len(token)

    def encode(self, text: str) -> np.ndarray:
        return self._span(text, 0, len(text))

    def _ids(self, text: str) -> np.ndarray:
        if len(text) <= LONG_BLANKS or not (run := LONG_RUN.search(text)):
            return self.core.encode_to_numpy(text, disallowed_special=())
        # The library's regex overflows its stack on so long a run; the pattern takes all of it but a last blank
        # that a non-blank follows.
        begin, end = run.start(), run.end() - (run.end() < len(text))
        blanks = np.asarray(self.core._encode_single_piece(text[begin:end].encode()), dtype=np.uint32)
        return np.concatenate([self._ids(text[:begin]), blanks, self._ids(text[end:])])

    def _span(self, text: str, lo: int, hi: int) -> np.ndarray:
        if hi - lo <= self.leaf:
            return self._ids(text[lo:hi])
        mid = (lo + hi) // 2
        return self._join(text, lo, mid, hi, self._span(text, lo, mid), self._span(text, mid, hi))

    def _join(self, text: str, lo: int, mid: int, hi: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        begin, end = mid, mid + 1
        while begin > lo and not final_cut(text, begin):
            begin -= 1
        while end < hi and not final_cut(text, end):
            end += 1
        keep = len(left) - self._tokens_in(left[::-1], len(text[begin:mid].encode()))
        skip = self._tokens_in(right, len(text[mid:end].encode()))
        return np.concatenate([left[:keep], self._ids(text[begin:end]), right[skip:]])

    def _tokens_in(self, ids: np.ndarray, n_bytes: int) -> int:
        """How many of the first ids make up n_bytes."""
        k = 64
        while True:
            ends = np.cumsum(self.width[ids[:k]])
            if k >= len(ids) or ends[-1] >= n_bytes:
                return int(np.searchsorted(ends, n_bytes)) + 1 if n_bytes else 0
            k *= 4

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) <= DECODE_LEAF:
            return self.core.decode_bytes(ids.tolist())
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


def final_cut(text: str, i: int) -> bool:
    """Whether a match of the split pattern begins at i in any text that holds the characters i - 1 and i there."""
    return text[i] in BLANKS and text[i - 1] not in BLANKS


@lru_cache(4)
def coder(ranks_path: str, pattern: str) -> Coder:
    return Coder(ranks_path, pattern)


def encode(text: Column, ranks_path: str, pattern: str) -> Column:
    """The ids of a text, array<int>. A null text is empty; an empty text has no ids."""

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = coder(ranks_path, pattern)
        for texts in batches:
            yield pd.Series([c.encode(t).astype(np.int32) for t in texts], dtype=object)

    return ids(F.coalesce(text, F.lit("")))


def decode(ids: Column, ranks_path: str, pattern: str) -> Column:
    """The bytes that the ids stand for, binary."""

    @F.pandas_udf("binary")
    def whole(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = coder(ranks_path, pattern)
        for rows in batches:
            yield pd.Series([c.decode(np.asarray(r)) for r in rows], dtype=object)

    return whole(ids)


def round_trip(text: Column, ranks_path: str, pattern: str) -> Column:
    """struct<ids, decoded>: a text's ids and the bytes that they stand for, by one worker. Nulls as in ``encode``."""

    @F.pandas_udf("struct<ids:array<int>,decoded:binary>")
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        c = coder(ranks_path, pattern)
        for texts in batches:
            ids = [c.encode(t).astype(np.int32) for t in texts]
            yield pd.DataFrame({"ids": pd.Series(ids, dtype=object), "decoded": pd.Series([c.decode(x) for x in ids], dtype=object)})

    return both(F.coalesce(text, F.lit("")))


def production() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def coded(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """docs(doc_id, text) -> doc_id, ids, decoded. Every row is coded by itself, repeated rows too."""
    out = docs.select("doc_id", encode(F.col("text"), ranks_path, pattern).alias("ids"))
    return out.select("doc_id", "ids", decode(F.col("ids"), ranks_path, pattern).alias("decoded"))


def digests(coded_docs: DataFrame) -> DataFrame:
    return coded_docs.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digests of every document's ids and of what they decode to. Null texts are empty, and empty texts
    have no ids; a null id stays null; repeated rows get equal rows; extra columns do not matter; an empty table gives
    an empty result."""
    small_batches(spark)
    return digests(coded(table(spark, sf_dir, "documents"), *production()))
