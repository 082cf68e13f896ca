"""Operator 2: personal data by offset-preserving deobfuscation.

Transducers rewrite a text into a plainer one: look-alike characters become the ones they imitate, spelled digits
become digits, and disguises of ``@`` and ``.`` become those. Each keeps for every output character the source span
it came from. Identifiers are detected in the source, which gives the base spans, and again in the rewritten text,
whose spans are mapped back and added where they hold something rewritten and reach beyond any base span of their kind.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studyloom.llm.common import small_batches, table

KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind:int,start:int,end:int,base:boolean>>"

# Look-alikes of ASCII characters beyond those that compatibility normalisation maps. Fixed values.
LOOKALIKES = dict(
    zip(
        "АВЕЅІЈКМНОРСТУХаеѕіјорсухһԁԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧαονιρυ‐‑‒–—―−․∙•",
        "ABESIJKMHOPCTYXaesijopcyxhdqwABEZHIKMNOPTYXaovipu-------...",
        strict=True,
    )
)
# Spelled digits in English, German, French and Spanish. Fixed values.
DIGITS = {
    "zero": 0, "oh": 0, "null": 0, "zéro": 0, "cero": 0, "one": 1, "eins": 1, "un": 1, "uno": 1, "two": 2, "zwei": 2, "zwo": 2, "deux": 2, "dos": 2,
    "three": 3, "drei": 3, "trois": 3, "tres": 3, "four": 4, "vier": 4, "quatre": 4, "cuatro": 4, "five": 5, "fünf": 5, "cinq": 5, "cinco": 5,
    "six": 6, "sechs": 6, "seis": 6, "seven": 7, "sieben": 7, "sept": 7, "siete": 7, "eight": 8, "acht": 8, "huit": 8, "ocho": 8,
    "nine": 9, "neun": 9, "neuf": 9, "nueve": 9,
}
AT, DOT = "at|@|arroba|chez|klammeraffe", r"dot|\.|punto|punkt|point|period"


def _plain_characters() -> dict[int, str]:
    """Code points whose compatibility form is one ASCII character, and the look-alikes. One for one."""
    out = {ord(a): b for a, b in LOOKALIKES.items()}
    for c in [*range(0xA0, 0x3100), *range(0xFE00, 0x10000), *range(0x1D400, 0x1D800), *range(0x1F100, 0x1F200)]:
        plain = unicodedata.normalize("NFKC", chr(c))
        digit = unicodedata.decimal(chr(c), None)
        if digit is not None:
            out[c] = str(digit)
        elif len(plain) == 1 and plain.isascii() and plain.isprintable() and chr(c) not in "ªº¹²³":
            out[c] = plain
    return out


GLYPHS = _plain_characters()
_DIGIT_WORDS = frozenset(DIGITS)
_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
#: What follows a domain's first label up to its last, which is of letters: the text behind a spelled "at" is a domain.
_REAL_DOT = r"(?:\.[A-Za-z0-9-]++)*\.[A-Za-z]{2,}(?![A-Za-z0-9-])"
_WORDS = "|".join(sorted(DIGITS, key=len, reverse=True))
#: One alternative for each transducer. A spelled digit counts beside another one, or beside a digit.
_REWRITE = re.compile(
    rf"(?P<at>[ \t]*{_OPEN}[ \t]*(?:{AT})[ \t]*{_CLOSE}[ \t]*"
    rf"|(?<=\w)[ \t_]+(?:at|arroba)[ \t_]+(?=[A-Za-z0-9-]+(?:[ \t_]+(?:dot|punto|punkt|point)[ \t_]+|[ \t]*{_OPEN}[ \t]*(?:{DOT})[ \t]*{_CLOSE}|{_REAL_DOT}))"
    r"|(?<=\w)(?:[ \t]+@[ \t]*|[ \t]*@[ \t]+)(?=\w))"
    rf"|(?P<dot>[ \t]*{_OPEN}[ \t]*(?:{DOT})[ \t]*{_CLOSE}[ \t]*|(?<=[A-Za-z0-9])[ \t_]+(?:dot|punto|punkt|point)[ \t_]+(?=[A-Za-z0-9]))"
    rf"|(?P<digit>(?<![^\W_])(?:{_WORDS})(?![^\W_]))"
    r"|(?P<zero>(?<=[0-9])[Oo](?=[0-9]))|(?P<one>(?<=[0-9])[lI](?=[0-9]))"
    r"|(?P<gone>[\xad​-‏⁠﻿])",
    re.IGNORECASE,
)
#: Spelled digits in a row, or one beside digits.
_SPELLED = re.compile(rf"(?<![^\W_])(?:{_WORDS})[ \t.,()_-]+(?:(?:{_WORDS})(?![^\W_])|[0-9])|[0-9][ \t.,()_-]*(?:{_WORDS})(?![^\W_])", re.IGNORECASE)
_BRACKETED = re.compile(rf"{_OPEN}[ \t]*(?:{AT}|{DOT})[ \t]*{_CLOSE}", re.IGNORECASE)
_PLAIN_DOT = re.compile(r"[ \t_](?:dot|punto|punkt|point)[ \t_]")
_PLAIN_AT = re.compile(r"[ \t_](?:at|arroba)[ \t_]+[a-z0-9-]++\.")
_MIXED = re.compile(r"[0-9][OolI][0-9]")
_LETTERS = re.compile(r"[^\W\d_]+")
_ODD = frozenset(map(chr, GLYPHS)) | frozenset("\xad\u200b\u200c\u200d\u200e\u200f\u2060\ufeff")


def _worth_rewriting(text: str) -> bool:
    """Whether a transducer may change something: tests that scan fast, so that most texts need no more."""
    if not text.isascii() and not _ODD.isdisjoint(text):
        return True
    low = text.lower()
    if "@ " in low or " @" in low or "@\t" in low or "\t@" in low or _MIXED.search(text):
        return True
    if ("dot" in low or "punto" in low or "punkt" in low or "point" in low) and _PLAIN_DOT.search(low):
        return True
    if "." in low and _PLAIN_AT.search(low):
        return True
    if ("(" in low or "[" in low or "{" in low or "<" in low) and _BRACKETED.search(low):
        return True
    return not _DIGIT_WORDS.isdisjoint(_LETTERS.findall(low)) and bool(_SPELLED.search(low))


class Rewritten:
    """A rewritten text; ``source`` maps its spans back."""

    def __init__(self, text: str):
        plain = text.translate(GLYPHS)
        parts: list[str] = []
        #: Output and source offsets at which runs begin: copied runs (width 0) and replaced ones (source width).
        self.out, self.src, self.width = [], [], []
        size = at = 0
        for m in _REWRITE.finditer(plain):
            kind = m.lastgroup
            new = {"at": "@", "dot": ".", "zero": "0", "one": "1", "gone": ""}.get(kind) if kind != "digit" else str(DIGITS[m[0].lower()])
            for piece, begin, width in ((plain[at : m.start()], at, 0), (new, m.start(), m.end() - m.start())):
                if piece:
                    self.out.append(size), self.src.append(begin), self.width.append(width)
                    parts.append(piece)
                    size += len(piece)
            at = m.end()
        self.out.append(size), self.src.append(at), self.width.append(0)
        self.text = "".join([*parts, plain[at:]])

    def _char(self, i: int) -> tuple[int, int]:
        k = bisect_right(self.out, i) - 1
        if self.width[k]:
            return self.src[k], self.src[k] + self.width[k]
        at = self.src[k] + i - self.out[k]
        return at, at + 1

    def source(self, start: int, end: int) -> tuple[int, int]:
        return self._char(start)[0], self._char(end - 1)[1]


_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9]){12,}")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def detect(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start: leftmost and non-overlapping within a kind."""
    out = []
    end = 0
    for m in _DOMAIN.finditer(text) if "@" in text else ():
        begin = m.start()
        while begin > end and text[begin - 1] in _LOCAL:
            begin -= 1
        if begin < m.start():
            end = m.end()
            out.append((0, begin, end))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if len(digits) <= 19 and _luhn(digits):
            out.append((2, *m.span()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= sum(map(str.isdigit, m[0])) <= 15:
            out.append((3, *m.span()))
    return out


def find(text: str) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, base) by kind, then start. Offsets are code points of the source, end exclusive."""
    base = [(*s, True) for s in detect(text)]
    if not _worth_rewriting(text):
        return base
    plain = Rewritten(text)
    if plain.text == text:
        return base
    added = []
    for kind, a, b in detect(plain.text):
        start, end = plain.source(a, b)
        if text[start:end] != plain.text[a:b] and not any(k == kind and s <= start and end <= e for k, s, e, _ in base):
            added.append((kind, start, end, False))
    return sorted(base + added)


def spans(text: Column) -> Column:
    """array<struct<kind, start, end, base>>; a null text is empty and has none."""

    @F.pandas_udf(SPANS)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([[dict(zip(("kind", "start", "end", "base"), s, strict=True)) for s in find(t)] for t in texts], dtype=object)

    return found(F.coalesce(text, F.lit("")))


def masked(text: Column, found: Column) -> Column:
    """The text with each span replaced by its kind, as ``<EMAIL>``; overlapping spans become the first one's mask."""

    @F.pandas_udf("string")
    def mask(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, rows in batches:
            yield pd.Series([_mask(t, s) for t, s in zip(texts, rows, strict=True)], dtype=object)

    return mask(text, found)


def masked_text(text: Column) -> Column:
    """The text with every span that ``find`` tells replaced by its kind, by one worker; a null text stays null."""

    @F.pandas_udf("string")
    def mask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([t if t is None else _mask(t, [dict(zip(("kind", "start", "end", "base"), s, strict=True)) for s in find(t)]) for t in texts], dtype=object)

    return mask(text)


def _mask(text: str | None, found) -> str | None:
    if text is None or len(found) == 0:
        return text
    out, at = [], 0
    for s in sorted(found, key=lambda s: (s["start"], -s["end"])):
        if s["start"] >= at:
            out += [text[at : s["start"]], f"<{KINDS[s['kind']].upper()}>"]
        at = max(at, s["end"])
    return "".join([*out, text[at:]])


def joined(found: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(found, one), ",")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    found = table(spark, sf_dir, "documents").select("doc_id", spans(F.col("text")).alias("found"))
    base = F.filter("found", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [F.size(F.array_remove(kinds, k)).cast("long") for k in range(len(KINDS))]
    counts = [(F.size(kinds) - n).cast("long").alias(f"n_{name}") for n, name in zip(counts, KINDS, strict=True)]
    more = F.size(F.filter("found", lambda s: ~s["base"])).cast("long").alias("n_added")
    return found.select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"), more)
