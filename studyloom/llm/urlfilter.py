"""Operator 4: URL filters by a Bloom filter cascade, plus rules for a host and its subdomains.

Level 1 of the cascade holds the listed keys. Level 2 holds the unlisted keys of the universe that level 1 lets
through, level 3 the listed ones that level 2 lets through, and so on until a level lets nothing wrong through. The
first level that a key fails decides, so membership is exact for every key of the universe, and no row of the
judged table is joined with or shuffled for the list. The production query's keys are pages, host and path.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studyloom.llm.common import lower_ascii, table
from studyloom.storage import staged

#: Bits of one page of a level, as ``bitmap_construct_agg`` makes them.
PAGE_BITS = 32768
#: Share of unlisted keys that a later level lets through; that of the first level follows from the keys.
LATER_RATE = 1 / 2
#: Bytes of filters that a pass over the judged rows carries. A longer list takes a pass for each such share of keys.
MAX_BYTES = 1 << 23

#: Labels of a host that put it on the list of the production query. Fixed values.
LISTED_LABELS = ("casino-win", "cheap-pills", "spam-farm")
#: verdict, host, path of the production query's rules. Fixed values.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, _URL, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


@dataclass(frozen=True)
class Level:
    """One Bloom filter: bit i of the filter is bit ``i % 8`` of byte ``i // 8``."""

    bits: bytes
    size: int
    hashes: int
    seed: int

    def spots(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(self.seed), F.lit(i)), F.lit(self.size)) for i in range(self.hashes)]

    def passes(self, key: Column) -> Column:
        filled, out = F.lit(bytearray(self.bits)), F.lit(True)
        for spot in self.spots(key):
            byte = F.conv(F.hex(F.substring(filled, F.shiftright(spot, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            out = out & (F.getbit(byte, (spot % 8).cast("int")) == 1)
        return out


def _level(keys: DataFrame, n: int, rate: float, seed: int) -> Level:
    """keys(key): n distinct ones. Bits are set by an aggregate per page; the driver gets one row of 4 kB a page."""
    size = max(64, math.ceil(n * math.log2(1 / rate) / math.log(2)))
    level = Level(b"", size, max(1, round(math.log2(1 / rate))), seed)
    spots = keys.select(F.explode(F.array(*level.spots(F.col("key")))).alias("spot")).distinct()
    pages = (
        spots.groupBy(F.floor(F.col("spot") / PAGE_BITS).alias("page"))
        .agg(F.bitmap_construct_agg(F.col("spot") % PAGE_BITS).alias("bits"))
        .collect()
    )
    whole = bytearray(-(-size // PAGE_BITS) * PAGE_BITS // 8)
    for r in pages:
        whole[r.page * PAGE_BITS // 8 : (r.page + 1) * PAGE_BITS // 8] = r.bits
    return Level(bytes(whole[: -(-size // 8)]), size, level.hashes, seed)


def first_rate(listed: int, others: int) -> float:
    """The share that keeps the whole cascade shortest: about the listed keys over the others, times root two."""
    return min(LATER_RATE, math.sqrt(2) * listed / max(1, others))


def bits_of(n: int, rate: float) -> float:
    return n * math.log2(1 / rate) / math.log(2) if n else 0.0


def passes_needed(listed: int, others: int) -> int:
    """Passes over the judged rows, each with the filters of its own share of the keys. Behind the first level, each
    two levels together halve the keys that are left of both kinds."""
    rate = first_rate(listed, others)
    later = 2 * bits_of(round(others * rate), LATER_RATE) + bits_of(listed, LATER_RATE)
    return max(1, math.ceil((bits_of(listed, rate) + later) / 8 / MAX_BYTES))


def cascade(universe: DataFrame) -> list[Level]:
    """universe(key, listed), keys distinct and not null -> the levels, until one lets nothing wrong through."""
    counts = {r.listed: r["count"] for r in universe.groupBy("listed").count().collect()}
    levels: list[Level] = []
    inside, n, rate = universe.where("listed"), counts.get(True, 0), first_rate(counts.get(True, 0), counts.get(False, 0))
    while n:
        levels.append(_level(inside, n, rate, len(levels)))
        even = len(levels) % 2 == 0
        inside = universe.where(F.col("listed") if even else ~F.col("listed"))
        for level in levels:
            inside = inside.where(level.passes(F.col("key")))
        n, rate = inside.count(), LATER_RATE
    return levels


def marked(rows: DataFrame, universe: DataFrame) -> DataFrame:
    """rows(key, ...), all keys of the universe(key, listed) -> rows with ``listed``, by the cascade."""
    universe = staged(universe, "url-universe")
    counts = {r.listed: r["count"] for r in universe.groupBy("listed").count().collect()}
    n = passes_needed(counts.get(True, 0), counts.get(False, 0))
    if n == 1:
        return rows.withColumn("listed", member(cascade(universe), F.col("key")))
    out = None
    for i in range(n):  # the driver holds the filters of one pass
        mine = F.pmod(F.xxhash64("key", F.lit("pass")), F.lit(n)) == i
        done = staged(rows.where(mine).withColumn("listed", member(cascade(universe.where(mine)), F.col("key"))), "url-judged")
        out = done if out is None else out.union(done)
    return out


def member(levels: list[Level], key: Column) -> Column:
    """Whether a key of the universe is listed: decided by the first level that it fails."""
    out = F.lit(len(levels) % 2 == 1)
    for i in reversed(range(len(levels))):
        out = F.when(~levels[i].passes(key), F.lit(i % 2 == 1)).otherwise(out)
    return out


def rule_of(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """The longest rule that fits (null if none) and its verdict."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def host_key() -> Column:
    return F.col("host")


def page_key() -> Column:
    """Host and path: no host has a slash, so neither part can be taken for the other."""
    return F.concat("host", "path")


def judge(pages: DataFrame, listed: DataFrame, rules=RULES, key=host_key) -> DataFrame:
    """pages(page_id, url), listed(key) -> page_id, host, path, rule, verdict, listed.

    A rule decides where one fits; else whether the page's key is listed. Null urls and those without ``://`` have an
    empty host and path, which may be listed like any other. Repeated pages are each judged; null keys of the list are
    ignored; an empty list allows all that no rule blocks; extra columns do not matter; an empty table gives an empty
    result."""
    pages = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).withColumn("key", key())
    listed = listed.where(F.col("key").isNotNull()).select("key", F.lit(True).alias("listed"))
    universe = pages.select("key", F.lit(False).alias("listed")).union(listed).groupBy("key").agg(F.max("listed").alias("listed"))
    found = marked(pages, universe)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rest = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return found.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, rest).alias("verdict"), "listed")


def listed_pages(pages: DataFrame, labels=LISTED_LABELS) -> DataFrame:
    """The corpus's pages, as keys, on hosts that have one of these labels: the list of the production query."""
    urls = pages.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    return urls.where(F.arrays_overlap(F.split("host", r"\."), F.array(*[F.lit(x) for x in labels]))).select(page_key().alias("key")).distinct()


def op4_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict: of a rule, else by the list of pages. Nulls, repeated rows and empty tables as in ``judge``."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, listed_pages(pages), key=page_key).drop("listed")


SQL = r"""
WITH p AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
r AS (SELECT *, CASE
  WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
  WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
  WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
  WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM p)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
  WHEN len(list_filter(string_split(host, '.'), lambda x: x IN ('casino-win', 'cheap-pills', 'spam-farm'))) > 0 THEN 'block'
  ELSE 'allow' END AS verdict FROM r
"""
