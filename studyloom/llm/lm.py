"""Operator 9: language-model scores by an interpolated modified Kneser-Ney trigram model.

Spark counts word trigrams, combined within a task and packed into a block of bytes for each part of the model. A part
holds all trigrams with one middle word, and with it everything that the estimate needs of that word: how often its
trigrams occur, what follows a pair that ends in it, how many distinct words stand before each pair that begins with
it, and how many before the word itself. So one shuffle is enough, and each part writes its sorted hash arrays where
they stay: one file in the shared folder, which scoring workers memory-map.

Frequent middle words, and then frequent pairs that end in them, are dealt to several parts; the few sums that they
need over their parts are a second, small aggregation. Which words are dealt so depends on the size of a part alone.
"""

from __future__ import annotations

import uuid
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studyloom.llm import arrays
from studyloom.llm.common import crc_mod, small_batches, table
from studyloom.storage import new_path, staged

#: Hashes of the end token and of the context at a text's start. No word hashes to them but by accident.
END, START = np.uint64(0xD1B54A32D192ED03), np.uint64(0x8CB92BA72F3D8DD7)
#: Tokens that a task combines at once, and tokens of a part of the model.
COMBINED, PART_TOKENS = 1 << 22, 1 << 21
#: The survey of frequent words reads a window of each text's every stride, and counts what a task saw so often.
WINDOW, STRIDE, NOTED = 512, 8192, 16
START_ID = np.array([START])
#: Trigrams pack three ids of this many bits into one number.
ID_BITS = 21
#: Keys of a bucket of an array on average; bits of a key kept beside its bucket.
BUCKET_KEYS, KEPT_BITS = 32, 32


def tokens(text: str) -> np.ndarray:
    """Hashes of the text's words, A-Z lower-cased, and of one end."""
    import xxhash

    words = text.encode().lower().split()  # of bytes: blank and \t to \r
    out = np.empty(len(words) + 1, dtype=np.uint64)
    out[:-1] = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    out[-1] = END
    return out


def mix(*columns) -> np.ndarray:
    """A 64-bit hash of rows of 64-bit numbers."""
    h = np.uint64(0x9E3779B97F4A7C15)
    for x in columns:
        h = (h ^ x) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


def _place(known: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where keys stand in a sorted array, and whether they do."""
    if not len(known):
        return np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=bool)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return at, known[at] == keys


@dataclass(frozen=True, eq=False)
class Deal:
    """Which part a trigram (u, v, w) goes to: by v; a frequent v's by u as well; a frequent pair's by w as well."""

    parts: int
    words: np.ndarray
    word_salts: np.ndarray
    pairs: np.ndarray
    pair_salts: np.ndarray

    def part(self, u, v, w) -> np.ndarray:
        if self.parts == 1:
            return np.zeros(len(v), dtype=np.uint32)
        at, hot = _place(self.words, v)
        one = two = np.zeros(len(v), dtype=np.uint64)
        if hot.any():
            one = np.where(hot, mix(u) % self.word_salts[at] + np.uint64(1), np.uint64(0))
            at, hot = _place(self.pairs, mix(u, v))
            if hot.any():
                two = np.where(hot, mix(w) % self.pair_salts[at] + np.uint64(1), np.uint64(0))
        return (mix(v, one, two) % np.uint64(self.parts)).astype(np.uint32)


def survey(docs: DataFrame) -> Deal:
    """docs(text), none null. A sixteenth of all texts' characters, spread over all of them, tells how many parts
    there are and which words and pairs exceed one: they are dealt to two parts for each that they would fill."""

    def seen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, texts = [], 0
        for pdf in batches:
            texts += len(pdf)
            for text in pdf.text:
                begin = int(mix(np.uint64(len(text)) ^ tokens(text[:64])[:1])[0]) % STRIDE
                held += [tokens(text[i : i + WINDOW]) for i in range(begin, len(text), STRIDE)]
        if not held:
            return
        w = np.concatenate(held)
        v = np.r_[START, w[:-1]]
        words, n = np.unique(w, return_counts=True)
        keys, first, m = np.unique(mix(v, w), return_index=True, return_counts=True)
        for kind, key, word, count in ((1, words, words, n), (2, keys, w[first], m)):
            often = count >= NOTED
            yield pd.DataFrame({"kind": kind, "key": key[often].view(np.int64), "word": word[often].view(np.int64), "n": count[often]})
        starts = -(-texts // (STRIDE // WINDOW))
        key = int(mix(START_ID, START_ID).view(np.int64)[0])
        signed = int(START_ID.view(np.int64)[0])
        yield pd.DataFrame({"kind": [0, 1, 2], "key": [0, signed, key], "word": [0, signed, signed], "n": [len(w), starts, starts]})

    found = docs.select("text").mapInPandas(seen, "kind int, key long, word long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"), F.min("word").alias("word"))
    found = staged(found, "lm-survey")
    total = found.where("kind = 0").agg(F.sum("n")).first()[0] or 0
    parts = max(1, -(-total * (STRIDE // WINDOW) // PART_TOKENS))
    rows = found.where((F.col("kind") > 0) & (F.col("n") * parts >= total)).collect() if parts > 1 else []  # parts words and pairs at most
    words = sorted((r.key % (1 << 64), r.n) for r in rows if r.kind == 1 and r.key % (1 << 64) != END)
    known = {w for w, _ in words}
    pairs = sorted((r.key % (1 << 64), r.n) for r in rows if r.kind == 2 and r.word % (1 << 64) in known)
    keys = lambda x: np.array([k for k, _ in x], dtype=np.uint64)
    salts = lambda x: np.array([-(-2 * n * parts // total) for _, n in x], dtype=np.uint64)
    return Deal(parts, keys(words), salts(words), keys(pairs), salts(pairs))


def _runs(*columns) -> np.ndarray:
    """Where runs of equal rows begin."""
    new = np.zeros(len(columns[0]), dtype=bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _planes(x: np.ndarray) -> bytes:
    """An array's first bytes, then its second bytes and so on, which compresses better."""
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def _packed(vocabulary: np.ndarray, v: np.ndarray, u: np.ndarray, w: np.ndarray, n: np.ndarray) -> bytes:
    """Trigrams of ids in a sorted vocabulary, sorted by v and u, as compressed bytes with the part of the vocabulary
    that they use."""
    import zstandard

    used = np.zeros(len(vocabulary), dtype=bool)
    used[v] = used[u] = used[w] = True
    own = np.flatnonzero(used)
    to = np.zeros(len(vocabulary), dtype="<u4")
    to[own] = np.arange(len(own))
    kind = "<u2" if len(own) <= 1 << 16 else "<u4"
    first = _runs(v)
    lengths = np.diff(np.r_[first, len(v)]).astype("<u4")
    head = np.array([len(own), len(v), len(first)], dtype="<u4")
    steps = np.diff(vocabulary[own].astype("<u8"), prepend=np.uint64(0))
    u_steps = np.diff(to[u].astype(kind), prepend=np.zeros(1, dtype=kind))
    columns = [steps, to[v[first]], lengths, u_steps, to[w].astype(kind), n.astype("<u4")]
    return zstandard.ZstdCompressor(level=1).compress(head.tobytes() + b"".join(map(_planes, columns)))


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """vocabulary, v, u, w, n of ``_packed``."""
    import zstandard

    data = zstandard.ZstdDecompressor().decompress(blob)
    own, rows, runs = np.frombuffer(data, dtype="<u4", count=3).tolist()
    at = 12

    def take(kind: str, size: int) -> np.ndarray:
        nonlocal at
        width = np.dtype(kind).itemsize
        planes = np.frombuffer(data, dtype=np.uint8, count=size * width, offset=at)
        at += size * width
        return np.ascontiguousarray(planes.reshape(width, size).T).view(kind).reshape(size)

    kind = "<u2" if own <= 1 << 16 else "<u4"
    steps, first, lengths = take("<u8", own), take("<u4", runs), take("<u4", runs)
    u_steps, w, n = take(kind, rows), take(kind, rows), take("<u4", rows)
    return np.cumsum(steps, dtype=np.uint64), np.repeat(first, lengths), np.cumsum(u_steps, dtype=kind), w, n


def _combined(kinds: int, u: np.ndarray, v: np.ndarray, w: np.ndarray, n: np.ndarray | None = None):
    """v, u, w, n of the distinct rows of ids below ``kinds``, sorted by v, u, w."""
    if kinds <= 1 << ID_BITS:
        key = v << 2 * ID_BITS
        key |= u << ID_BITS
        key |= w
        if n is None:
            key.sort()
        else:
            order = np.argsort(key, kind="stable")
            key, n = key[order], n[order]
        first = _runs(key)
        low = (1 << ID_BITS) - 1
        v, u, w = key[first] >> 2 * ID_BITS, key[first] >> ID_BITS & low, key[first] & low
    else:
        order = np.lexsort((w, u, v))
        v, u, w = v[order], u[order], w[order]
        n = n if n is None else n[order]
        first = _runs(v, u, w)
        key, v, u, w = order, v[first], u[first], w[first]
    n = np.diff(np.r_[first, len(key)]) if n is None else np.add.reduceat(n.astype(np.int64), first)
    return v, u, w, n


def pack_trigrams(docs: DataFrame, deal: Deal) -> DataFrame:
    """docs(text), none null -> part, blob: trigrams with their counts, COMBINED tokens combined at a time."""
    shared = docs.sparkSession.sparkContext.broadcast(deal)  # parts words and pairs at most

    def blobs(held: list[np.ndarray]) -> Iterator[pd.DataFrame]:
        vocabulary, ids = np.unique(np.concatenate([np.r_[START, START, x] for x in held]), return_inverse=True)
        held.clear()
        start, rows = np.searchsorted(vocabulary, START), len(ids) - 2
        for i in range(0, rows, COMBINED):
            end = min(i + COMBINED, rows)
            v, u, w, n = _combined(len(vocabulary), ids[i:end], ids[i + 1 : end + 1], ids[i + 2 : end + 2])
            inside = w != start  # the others reach over from one text to the next
            v, u, w, n = v[inside], u[inside], w[inside], n[inside]
            part = shared.value.part(vocabulary[u], vocabulary[v], vocabulary[w])
            order = np.argsort(part.astype(np.uint16) if shared.value.parts <= 1 << 16 else part, kind="stable")
            first = _runs(part[order])
            edges = np.r_[first, len(order)].tolist()
            out = [_packed(vocabulary, v[x], u[x], w[x], n[x]) for a, b in zip(edges, edges[1:], strict=False) for x in (order[a:b],)]
            yield pd.DataFrame({"part": part[order[first]].astype(np.int64), "blob": pd.Series(out, dtype=object)})

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for pdf in batches:
            for text in pdf.text:
                held.append(tokens(text))
                size += len(held[-1])
                if size >= COMBINED:
                    yield from blobs(held)  # empties it
                    size = 0
        if held:
            yield from blobs(held)

    return docs.select("text").mapInPandas(counted, "part long, blob binary")


def _bucket_bits(n: int) -> int:
    return max(0, min(KEPT_BITS, (n // BUCKET_KEYS).bit_length() - 1))


def _code_kind(n: int) -> str:
    return "<u1" if n <= 1 << 8 else "<u2" if n <= 1 << 16 else "<u4"


class Table:
    """Distinct 64-bit keys in order, each with a row of numbers.

    A key's first bits are its bucket and the next KEPT_BITS are stored, so a key that is absent is taken for a stored
    one once in 2 ** KEPT_BITS / BUCKET_KEYS times, 7e-9, whatever the size. Rows of numbers are stored once each. A
    bit for each key tells whether it has another row than the commonest; those that have follow as row numbers."""

    def __init__(self, rows: np.ndarray, other: np.ndarray, rank: np.ndarray, buckets: np.ndarray, kept: np.ndarray, code: np.ndarray):
        self.bits = (len(buckets) - 1).bit_length() - 1
        self.rows, self.other, self.rank, self.buckets, self.kept, self.code = rows, other, rank, buckets, kept, code

    @staticmethod
    def to_bytes(keys: np.ndarray, values: np.ndarray) -> tuple[bytes, list[int]]:
        """The bytes, a multiple of eight, and what ``from_bytes`` has to know: keys, rows, columns, row numbers."""
        order = np.argsort(keys)
        keys, values = keys[order], values[order]
        bits = _bucket_bits(len(keys))
        spot, kept = Table._cut(keys, bits)
        buckets = np.searchsorted(spot, np.arange((1 << bits) + 1)).astype("<u4")
        mark = values[:, 0].astype(np.uint64) if values.shape[1] == 1 else mix(*values.T.astype(np.uint64))
        _, first, code = np.unique(mark, return_index=True, return_inverse=True)
        if len(first):  # the commonest row is number 0
            common = np.argmax(np.bincount(code))
            to = np.arange(len(first))
            to[[0, common]] = common, 0
            first, code = first[to], to[code]
        other = np.packbits(code != 0, bitorder="little")
        other = np.r_[other, np.zeros(-len(other) % 8, dtype=np.uint8)].view("<u8")
        rank = np.cumsum(np.r_[0, np.bitwise_count(other)])[:-1].astype("<u4")
        code = code[code != 0].astype(_code_kind(len(first)))
        out = b"".join(c.tobytes() for c in (values[first].astype("<i8"), other, rank, buckets, kept.astype("<u4"), code))
        return out + bytes(-len(out) % 8), [len(keys), len(first), values.shape[1], len(code)]

    @staticmethod
    def from_bytes(data: np.ndarray, at: int, n: int, rows: int, columns: int, codes: int) -> tuple[Table, int]:
        """A table in mapped bytes, and where it ends."""
        parts, words = [], -(-n // 64)
        sizes = (("<i8", rows * columns), ("<u8", words), ("<u4", words), ("<u4", (1 << _bucket_bits(n)) + 1), ("<u4", n), (_code_kind(rows), codes))
        for kind, size in sizes:
            end = at + size * np.dtype(kind).itemsize
            parts.append(data[at:end].view(kind))
            at = end
        return Table(parts[0].reshape(rows, columns), *parts[1:]), at + -at % 8

    @staticmethod
    def _cut(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        spot = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), dtype=np.int64)
        return spot, (keys >> np.uint64(64 - bits - KEPT_BITS)).astype(np.uint32)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are stored, and their rows."""
        spot, kept = self._cut(keys, self.bits)
        low, high = self.buckets[spot].astype(np.int64), self.buckets[spot + 1].astype(np.int64)
        end = high
        for _ in range(int((high - low).max(initial=0)).bit_length()):
            middle = (low + high) >> 1
            under = self.kept[np.minimum(middle, len(self.kept) - 1)] < kept
            under &= low < high
            low = np.where(under, middle + 1, low)
            high = np.where(under, high, middle)
        hit = np.flatnonzero(low < end)
        hit = hit[self.kept[low[hit]] == kept[hit]]
        at = low[hit]
        word, bit = self.other[at >> 6], (at & 63).astype(np.uint64)
        coded = np.flatnonzero((word >> bit) & np.uint64(1))
        before = np.bitwise_count(word[coded] & ((np.uint64(1) << bit[coded]) - np.uint64(1)))
        code = np.zeros(len(hit), dtype=np.int64)
        code[coded] = self.code[self.rank[at[coded] >> 6].astype(np.int64) + before]
        return hit, self.rows[code]


FOUND = "kind int, a long, b long, key long, n long, x long, y long, z long, path string, sizes array<long>, facts array<long>"
#: Kinds of rows: a part, a pair (a, b) and its share of predecessors, a word a, a pair (by key) that ends in word a.
PART, PAIR, WORD, CONTEXT = range(4)
#: What is summed over parts: tokens, distinct words, texts, words before an end, distinct pairs; then how many trigrams,
#: pairs and words have a count of 1 to 4.
FACTS = 5 + 3 * 4


def _often(counts: np.ndarray) -> list[int]:
    return [int(np.count_nonzero(counts == k)) for k in range(1, 5)]


def _classes(counts: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """By run: how many of its counts are 1, 2 and more."""
    return [np.add.reduceat(c.astype(np.int64), first) for c in (counts == 1, counts == 2, counts > 2)]


def _write(path: str, tables: list[tuple[np.ndarray, np.ndarray]]) -> tuple[str, list[int]]:
    parts = [Table.to_bytes(*t) for t in tables]
    return arrays.write(path, [data for data, _ in parts]), [n for _, size in parts for n in size]


def _part_writer(deal, path: str):
    """part, blobs -> rows of FOUND; the part's tables are words, trigrams, contexts and pairs."""

    def write(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        blobs = [_unpacked(b) for b in pdf.blob]
        name, to = np.unique(np.concatenate([b[0] for b in blobs]), return_inverse=True)  # an id's hash
        begins = np.cumsum([0] + [len(b[0]) for b in blobs])
        v, u, w = (np.concatenate([to[b[i] + np.int64(at)] for b, at in zip(blobs, begins, strict=False)]) for i in (1, 2, 3))
        v, u, w, n = _combined(len(name), u, v, w, np.concatenate([b[4] for b in blobs]))
        hot_word = _place(deal.value.words, name)[1]
        first = _runs(v, u)
        cv, cu = v[first], u[first]
        context = mix(name[cu], name[cv])
        stats = np.stack([np.add.reduceat(n, first), *_classes(n, first)], axis=1)
        hot_pair = _place(deal.value.pairs, context)[1]
        # pairs (v, w): how many distinct words before; at a text's start, where none can be, how often they occur
        order = np.argsort((v << 32) | w, kind="stable")
        pv, pw = v[order], w[order]
        begin = _runs(pv, pw)
        a = np.add.reduceat(np.where(name[pv] == START, n[order], 1), begin)
        pv, pw = pv[begin], pw[begin]
        # words v
        words, at = _runs(cv), _runs(pv)
        kinds = cv[words]
        used = np.where(name[kinds] == START, 0, np.add.reduceat(stats[:, 0], words))
        before = np.where(name[kinds] == START, 0, np.add.reduceat((~hot_pair).astype(np.int64), words))
        rows = np.stack([used, before, np.add.reduceat(a, at), *_classes(a, at)], axis=1)
        cold, cold_pair, kept = ~hot_word[kinds], ~hot_word[pv], ~hot_pair
        file, sizes = _write(
            path,
            [
                (name[kinds[cold]], rows[cold]),
                (mix(name[u], name[v], name[w]), n[:, None]),
                (context[kept], stats[kept]),
                (mix(name[pv[cold_pair]], name[pw[cold_pair]]), a[cold_pair, None]),
            ],
        )
        ends = name[w] == END
        facts = [used[cold].sum(), np.count_nonzero(used[cold]), n[ends].sum(), np.count_nonzero(name[pw[cold_pair]] == END), np.count_nonzero(cold_pair)]
        facts += _often(n) + _often(a[cold_pair]) + _often(before[cold])
        signed = lambda x: x.view(np.int64)
        empty = {c.split()[0]: 0 for c in FOUND.split(", ")[:8]}
        out = [pd.DataFrame([{**empty, "kind": PART, "key": key[0], "path": file, "sizes": sizes, "facts": [int(x) for x in facts]}])]
        for kind, size, values in (
            (PAIR, np.count_nonzero(~cold_pair), lambda: {"a": signed(name[pv[~cold_pair]]), "b": signed(name[pw[~cold_pair]]), "n": a[~cold_pair]}),
            (WORD, np.count_nonzero(~cold), lambda: {"a": signed(name[kinds[~cold]]), "n": used[~cold], "x": before[~cold]}),
            (CONTEXT, np.count_nonzero(hot_pair), lambda: {"a": signed(name[cv[hot_pair]]), "key": signed(context[hot_pair]), **dict(zip("nxyz", stats[hot_pair].T, strict=True))}),
        ):
            if size:
                out.append(pd.DataFrame({**empty, "kind": kind, **values(), "path": None, "sizes": None, "facts": None}))
        return pd.concat(out, ignore_index=True)

    return write


def _pair_writer(path: str):
    """file, pairs(a, b, n) -> file, path, sizes."""

    def write(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        hashed = mix(pdf.a.to_numpy().view(np.uint64), pdf.b.to_numpy().view(np.uint64))
        name, sizes = _write(path, [(hashed, pdf.n.to_numpy()[:, None])])
        return pd.DataFrame({"file": [key[0]], "path": [name], "sizes": [sizes]})

    return write


@dataclass(frozen=True, eq=False)
class Model:
    """Where the arrays are, what is known of frequent words and pairs, and the few totals."""

    id: str
    deal: Deal
    #: path and sizes of each part; of each file of frequent words' pairs, and how many of those files there can be.
    parts: dict[int, tuple[str, list[int]]]
    pair_files: dict[int, tuple[str, list[int]]]
    n_files: int
    #: Rows as a part's tables have them, for deal.words and deal.pairs.
    words: np.ndarray
    contexts: np.ndarray
    tokens: int
    kinds: int
    texts: int
    before_end: int
    pair_kinds: int
    #: Discounts of counts 1, 2 and more, for words, pairs and trigrams; what the words leave to unseen ones.
    discounts: list[tuple[float, float, float]]
    rest: float


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and more, from how many grams have a count of 1 to 4; 0.5, 1 and
    1.5 where those are too few to tell."""
    n1, n2, n3, n4 = n
    if not all(n):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return d if all(0 < x < k for k, x in enumerate(d, 1)) else (0.5, 1.0, 1.5)


def learn(docs: DataFrame) -> Model:
    """docs(text): what to learn from. Every text ends in an end token, so a null or empty one is that token alone."""
    spark = docs.sparkSession
    docs = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    deal = survey(docs)
    path = new_path(spark, "lm-arrays")
    blobs = pack_trigrams(docs, deal)
    found = staged(blobs.groupBy("part").applyInPandas(_part_writer(spark.sparkContext.broadcast(deal), path), FOUND), "lm-found")
    parts = found.where(F.col("kind") == PART).select("key", "path", "sizes", "facts").collect()  # a row for a part
    facts = np.array([r.facts for r in parts] or [[0] * FACTS]).sum(axis=0)
    words = {r.a % (1 << 64): r for r in found.where(F.col("kind") == WORD).groupBy("a").agg(F.sum("n").alias("n"), F.sum("x").alias("x")).collect()}
    contexts = found.where(F.col("kind") == CONTEXT).groupBy("key").agg(F.min("a").alias("a"), *[F.sum(c).alias(c) for c in "nxyz"])
    contexts = {r.key % (1 << 64): r for r in contexts.collect()}  # a part's worth of trigrams each, as the words
    files, n_files, followers = {}, 1, {}
    if len(deal.words):
        pairs = staged(found.where(F.col("kind") == PAIR).groupBy("a", "b").agg(F.sum("n").alias("n")), "lm-pairs")
        n_files = max(1, -(-pairs.count() // PART_TOKENS))
        dealt = pairs.withColumn("file", F.pmod("b", F.lit(n_files).cast("long")))
        written = dealt.groupBy("file").applyInPandas(_pair_writer(path), "file long, path string, sizes array<long>")
        files = {r.file: (r.path, list(r.sizes)) for r in written.collect()}
        is_one = lambda c: F.sum(c.cast("long"))
        n = F.col("n")
        sums = [F.sum("n"), is_one(n == 1), is_one(n == 2), is_one(n > 2), is_one(n == 3), is_one(n == 4), is_one(F.col("b") == END.view(np.int64)), F.count(F.lit(1))]
        followers = {r[0] % (1 << 64): r[1:] for r in pairs.groupBy("a").agg(*sums).collect()}  # a row for each frequent word
    hot = np.zeros((len(deal.words), 6), dtype=np.int64)
    for i, v in enumerate(deal.words.tolist()):
        r, f = words.get(v), followers.get(v)
        if r is None or f is None:
            continue
        before = r.x + sum(c.a % (1 << 64) == v for c in contexts.values()) if v != START else 0
        hot[i] = (r.n, before, *f[:4])
        facts[:2] += (r.n, r.n > 0)
        facts[3:5] += (f[6], f[7])
        facts[9:13] += (f[1], f[2], f[4], f[5])
        if 1 <= before <= 4:
            facts[12 + before] += 1
    held = np.array([[contexts[k][c] for c in "nxyz"] if k in contexts else [0] * 4 for k in deal.pairs.tolist()], dtype=np.int64).reshape(-1, 4)
    total, kinds, texts, before_end, pair_kinds = facts[:5].tolist()
    if before_end:
        kinds += 1
        if before_end <= 4:
            facts[12 + before_end] += 1
    by_order = [discounts(facts[i : i + 4].tolist()) for i in (13, 9, 5)]
    one, two = facts[13:15].tolist()
    rest = sum(d * c for d, c in zip(by_order[0], (one, two, kinds - one - two), strict=True)) / pair_kinds if pair_kinds else 1.0
    return Model(
        uuid.uuid4().hex, deal, {r.key: (r.path, list(r.sizes)) for r in parts}, files, n_files, hot, held, total + texts, kinds, texts, before_end, pair_kinds, by_order, rest
    )


def _discounted(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return counts - np.where(counts > 2, d[2], np.where(counts == 2, d[1], np.where(counts == 1, d[0], 0.0)))


def _left(stats: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    """stats(total, once, twice, more) of contexts -> what they leave to the lower order; all, where nothing is known."""
    return np.where(stats[:, 0] > 0, stats[:, 1:] @ np.array(d) / np.maximum(stats[:, 0], 1), 1.0)


#: Files that a worker maps at a time, of however many parts the model has.
MAX_OPEN = 128


class Scorer:
    """Looks texts up in the parts' tables. A part's file is mapped when a batch asks for it; the least recently used one goes where
    MAX_OPEN are mapped already, so that descriptors and mappings do not grow with the model."""

    def __init__(self, model: Model):
        self.model = model
        self.mapped: OrderedDict[str, list[Table]] = OrderedDict()

    def _tables(self, path: str, sizes: list[int]) -> list[Table]:
        if path in self.mapped:
            self.mapped.move_to_end(path)
            return self.mapped[path]
        while len(self.mapped) >= MAX_OPEN:
            self.mapped.popitem(last=False)
        data, at, out = arrays.mapped(path), 0, []
        for i in range(0, len(sizes), 4):
            t, at = Table.from_bytes(data, at, *sizes[i : i + 4])
            out.append(t)
        self.mapped[path] = out
        return out

    def _find(self, which: int, parts: np.ndarray, keys: np.ndarray, columns: int) -> np.ndarray:
        """The rows of keys in a table of their parts, zeros where they are absent."""
        out = np.zeros((len(keys), columns), dtype=np.int64)
        order = np.argsort(parts.astype(np.uint16) if self.model.deal.parts <= 1 << 16 else parts, kind="stable")
        first = _runs(parts[order])
        for a, b in zip(first, np.r_[first, len(order)][1:], strict=True):
            at = order[a:b]
            if part := self.model.parts.get(int(parts[at[0]])):
                hit, rows = self._tables(*part)[which].find(keys[at])
                out[at[hit]] = rows
        return out

    def score(self, texts: list[str]) -> pd.DataFrame:
        """n_tokens, n_known, base_score, score of each text, looked up together."""
        m, held = self.model, [tokens(t) for t in texts]
        sizes = np.array([len(x) for x in held])
        begins = np.cumsum(sizes) - sizes
        d1, d2, d3 = m.discounts
        names, ids = np.unique(np.r_[START, np.concatenate(held)], return_inverse=True)
        start, w = ids[0], ids[1:]
        v = np.r_[start, w[:-1]]
        v[begins] = start
        # words
        info = self._find(0, self._home(names), names, 6)
        at, hot = _place(m.deal.words, names)
        info[hot] = m.words[at[hot]]
        info[names == END] = (m.texts, m.before_end, 0, 0, 0, 0)
        used, before, follow = info[:, 0], info[:, 1], info[:, 2:]
        p1 = _discounted(before, d1) / max(m.pair_kinds, 1) + m.rest / (m.kinds + 1)
        # pairs; that of the two starts is the context of a text's first token
        pair, at_pair = np.unique(np.r_[(start << 32) | start, (v << 32) | w], return_inverse=True)
        pv, pw = pair >> 32, pair & 0xFFFFFFFF
        hot = hot[pv]
        keys = mix(names[pv], names[pw])
        a = np.zeros((len(pair), 1), dtype=np.int64)
        cold = np.flatnonzero(~hot)
        a[cold] = self._find(3, self._home(names[pv[cold]]), keys[cold], 1)
        files = names[pw].view(np.int64) % m.n_files
        for k, file in m.pair_files.items():
            at = np.flatnonzero(hot & (files == k))
            if len(at):
                hit, rows = self._tables(*file)[0].find(keys[at])
                a[at[hit]] = rows
        total = follow[pv, 0]
        p2 = _discounted(a[:, 0], d2) / np.maximum(total, 1) + _left(follow, d2)[pv] * p1[pw]
        # what follows a pair (pv, pw), which is the context of the token after it
        after = self._find(2, m.deal.part(names[pv], names[pw], names[pw]), keys, 4)
        at, known = _place(m.deal.pairs, keys)
        after[known] = m.contexts[at[known]]
        first = at_pair[0]
        at_pair = at_pair[1:]
        context = np.r_[first, at_pair[:-1]]
        context[begins] = first
        u = pv[context]
        c = self._find(1, m.deal.part(names[u], names[v], names[w]), mix(names[u], names[v], names[w]), 1)[:, 0]
        p3 = _discounted(c, d3) / np.maximum(after[context, 0], 1) + _left(after, d3)[context] * p2[at_pair]
        base = np.log10((used + 0.1) / (m.tokens + 0.1 * (m.kinds + 1)))
        return pd.DataFrame(
            {
                "n_tokens": sizes,
                "n_known": np.add.reduceat((used > 0)[w].astype(np.int64), begins),
                "base_score": np.add.reduceat(base[w], begins),
                "score": np.add.reduceat(np.log10(p3), begins),
            }
        )

    def _home(self, words: np.ndarray) -> np.ndarray:
        """The part of words that are not frequent, and of the pairs that begin with them."""
        zero = np.zeros(len(words), dtype=np.uint64)
        return (mix(words, zero, zero) % np.uint64(self.model.deal.parts)).astype(np.uint32)


_SCORERS: dict[str, Scorer] = {}


def _scorer(model: Model) -> Scorer:
    """The worker's scorer of a model, the last one only."""
    if model.id not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[model.id] = Scorer(model)
    return _SCORERS[model.id]


SCORES = "n_tokens long, n_known long, base_score double, score double"
#: Texts looked up together hold this many characters, or one text.
LOOKED_UP = 1 << 22


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """docs(doc_id, text, held_out) -> doc_id, held_out and SCORES. A null text is empty: one token, the end."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a line for PART_TOKENS tokens, and parts words and pairs

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = _scorer(shared.value)

        def done(parts: list[pd.DataFrame]) -> pd.DataFrame:
            pdf = pd.concat(parts, ignore_index=True)
            return pd.concat([pdf[["doc_id", "held_out"]], scorer.score(list(pdf.text))], axis=1)

        parts, size = [], 0
        for pdf in batches:
            if not len(pdf):
                continue
            parts.append(pdf)
            size += int(pdf.text.str.len().sum())
            if size >= LOOKED_UP:
                yield done(parts)
                parts, size = [], 0
        if parts:
            yield done(parts)

    d = docs.select("doc_id", "held_out", F.coalesce("text", F.lit("")).alias("text"))
    return d.mapInPandas(score, f"doc_id long, held_out boolean, {SCORES}")


def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose crc32 modulo 10 is 0 are held out. perplexity: 10 to the negative mean of the tokens' scores.

    Null and empty texts are one token, the end; rows with a null id are learned from or held out like others; repeated
    rows count as often as they occur and get equal scores; extra columns do not matter; nothing to learn from leaves
    one share to all tokens, and an empty table gives an empty result."""
    small_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (crc_mod(F.col("doc_id"), 10) == 0).alias("held_out"))
    model = learn(docs.where(~F.col("held_out")))
    out = scored(docs, model).withColumn("train_tokens", F.lit(model.tokens).cast("long"))
    return out.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
