"""Operator 11: a Merkle manifest of a dataset, with a proof for every row.

A row's leaf is a digest of its fields. The leaves of a language stand in the order of their ids; runs of eight become
their digest until one node remains, the language's subroot, and the subroots give the root in the same way.

The eight-ary digits of a leaf's rank say where it stands: digit k is its place in its run at level k. Leaves are dealt
to blocks of 8^DIGITS consecutive ranks, the only shuffle of theirs besides the sort, and inside a block the digit
columns are grouped away one after the other, each time nesting the children in their parent. What is above the blocks
is a tree of the same kind over the blocks' digests, a row for 4,096 leaves, and so on; its siblings come back to the
blocks by one equi-join of these slim rows. The proofs then leave the nested rows by transform and explode: no leaf
ever takes part in a join for its proof.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from studyloom.llm.common import crc_mod, lower_ascii, table
from studyloom.storage import staged

#: Children of a node; digits of a rank inside a block, whose 8^4 leaves bound a nested row; mean rows of a range.
FAN, DIGITS, RANGE_ROWS = 8, 4, 1 << 18
LEVELS = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_of(*fields: Column) -> Column:
    """Digest of the fields, each as `-` if null, else as its number of UTF-8 bytes, `:`, and its text."""

    def framed(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return digest(*[framed(f) for f in fields])


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """rows with rank (from 0, by ``order``, nulls first) among those with the same group, and n, the group's rows.

    Ranges of the global order number their rows by themselves; what a group has in earlier ranges is a prefix sum over
    a row for each range and group. Equal rows are told apart by where they were read, so that no value, however
    frequent, has to lie in one range."""
    rows = staged(rows.withColumn("_at", F.monotonically_increasing_id()), "merkle-rows")
    by = [F.col(c).asc_nulls_first() for c in (group, *order, "_at")]
    ranges = max(1, -(-rows.count() // RANGE_ROWS))
    line = rows.repartitionByRange(ranges, *by).sortWithinPartitions(*by)
    line = line.withColumn("_range", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id()).drop("_at")
    line = staged(line, "merkle-line")
    held = line.groupBy("_range", group).agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_held"))
    same, earlier = W.partitionBy(group), W.partitionBy(group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    held = held.withColumn("_before", F.coalesce(F.sum("_held").over(earlier), F.lit(0))).withColumn("n", F.sum("_held").over(same))
    l, h = line.alias("l"), held.alias("h")
    out = l.join(h, (F.col("l._range") == F.col("h._range")) & F.col(f"l.{group}").eqNullSafe(F.col(f"h.{group}")))
    return out.select("l.*", "h.n", (F.col("l._row") - F.col("h._first") + F.col("h._before")).alias("rank")).drop("_range", "_row")


def nested(nodes: DataFrame, group: str, digits: int) -> DataFrame:
    """nodes(group, rank, n, node: struct with hash) -> group, block, n, hash, kids: a row for each 8^digits ranks. A
    level stands only while more than one node of the group remains: below, a lone node is passed on as it is."""
    at = [F.shiftright("rank", 3 * k).bitwiseAND(FAN - 1).cast("int").alias(f"d{k}") for k in range(digits)]
    d = nodes.select(group, F.shiftright("rank", 3 * digits).alias("block"), "n", *at, "node").repartition(group, "block")
    for k in range(digits):
        keys = [group, "block", "n", *[f"d{j}" for j in range(k + 1, digits)]]
        d = d.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(F.col(f"d{k}").alias("digit"), "node"))).alias("kids"))
        d = d.withColumn("kids", F.transform("kids", lambda x: x["node"]))
        joined = F.sha2(F.array_join(F.transform("kids", lambda x: x["hash"]), "").cast("binary"), 256)
        d = d.withColumn("hash", F.when(F.col("n") > FAN**k, joined).otherwise(F.col("kids")[0]["hash"]))
        d = d.select(*keys, F.struct("hash", "kids").alias("node"))
    return d.select(group, "block", "n", "node.hash", "node.kids")


def above(blocks: DataFrame, group: str, digits: int) -> DataFrame:
    """Staged blocks with root and levels: the siblings above them, lowest first, from a tree over the blocks."""
    most = blocks.agg(F.max("n")).first()[0] or 0
    if most <= FAN**digits:
        return blocks.select("*", F.col("hash").alias("root"), F.array().cast(LEVELS).alias("levels"))
    up = blocks.select(group, F.col("block").alias("rank"), F.ceil(F.col("n") / FAN**digits).cast("long").alias("n"), F.struct("hash").alias("node"))
    up = above(staged(nested(up, group, digits), "merkle-upper"), group, digits)
    up = staged(siblings(up.withColumnRenamed("block", "_block"), [group, "_block", "root"], digits), "merkle-siblings")
    up = up.select(F.col(group).alias("_g"), (F.col("_block") * FAN**digits + F.col("place")).alias("_b"), "root", "levels")
    return blocks.join(up, F.col(group).eqNullSafe(F.col("_g")) & (F.col("block") == F.col("_b"))).drop("_g", "_b")


def siblings(blocks: DataFrame, keep: list[str], digits: int) -> DataFrame:
    """blocks(n, levels, kids, *keep) -> *keep, place (the rank inside its block), the fields of the nodes that were
    nested, and levels, now from each node's own run on."""
    d = blocks.select(*keep, "n", "levels", F.lit(0).alias("place"), "kids")
    for k in reversed(range(digits)):
        hashes = F.transform("kids", lambda x: x["hash"]).alias("hashes")
        d = d.select(*keep, "n", "levels", "place", hashes, F.posexplode("kids").alias("i", "kid"))
        side = lambda start, length: F.array_join(F.slice("hashes", start, length), "")
        level = F.struct(side(F.lit(1), F.col("i")).alias("before"), side(F.col("i") + 2, F.lit(FAN)).alias("after"))
        levels = F.when(F.col("n") > FAN**k, F.concat(F.array(level), F.col("levels"))).otherwise(F.col("levels"))
        d = d.select(*keep, "n", levels.alias("levels"), (F.col("place") * FAN + F.col("i")).alias("place"), "kid.*")
    return d.drop("n")


def manifest(leaves: DataFrame, group: str, order: list[str], digits: int = DIGITS) -> DataFrame:
    """leaves(group, *order, leaf, ...) -> their columns, hash (the leaf), subroot, root, levels: for each level from the
    leaf up to the root the concatenated digests that stand before and after it in its run.

    Ties in the order go by the leaf; a null group is a group and comes first, null ids come first; repeated rows are
    leaves of their own; groups have any number of leaves, a lone leaf being its own subroot; no leaves give no rows."""
    place = ranked(leaves, group, [*order, "leaf"])
    fields = [c for c in leaves.columns if c not in (group, "leaf")]
    nodes = place.select(group, "rank", "n", F.struct(F.col("leaf").alias("hash"), *fields).alias("node"))
    blocks = above(staged(nested(nodes, group, digits), "merkle-blocks"), group, digits)
    subroots = blocks.where("block = 0").select(F.lit(0).alias("_all"), F.col(group).alias("_g"), F.col("root").alias("leaf"))
    subroots = ranked(subroots, "_all", ["_g"])
    tops = nested(subroots.select("_all", "rank", "n", F.struct(F.col("leaf").alias("hash"), "_g").alias("node")), "_all", digits)
    tops = siblings(above(staged(tops, "merkle-tops"), "_all", digits), ["root"], digits)
    tops = staged(tops.select("_g", F.col("root").alias("_root"), F.col("levels").alias("_levels")), "merkle-groups")
    blocks = blocks.withColumnRenamed("root", "subroot").join(tops, F.col(group).eqNullSafe(F.col("_g")))
    blocks = blocks.withColumn("levels", F.concat("levels", "_levels")).withColumnRenamed("_root", "root")
    return siblings(blocks, [group, "subroot", "root"], digits).drop("place")


def proof(levels: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(levels, lambda x: F.concat(x["before"], x["after"])), "").cast("binary"), 256)


def folded(leaf: Column, levels: Column) -> Column:
    """The root that follows from a leaf and the siblings above it."""
    return F.aggregate(levels, leaf, lambda h, x: digest(x["before"], h, x["after"]))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots, proof and verification of every document, a third of the ids tampered with.

    Nulls are fields of their own form; a null id counts as the empty text in the choice of tampered rows, and stands
    before others; equal ids go by leaf; repeated rows are leaves of their own, with proofs of their own; extra columns
    do not matter; an empty table gives an empty result. Long texts are hashed where they are read and not moved."""
    docs = table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.when(crc_mod(F.col("doc_id"), 3) == 0, leaf_of(*fields, lower_ascii(F.col("text"))))
    leaves = docs.select("lang", "doc_id", leaf_of(*fields, F.col("text")).alias("leaf"), tampered.alias("tampered"))
    out = manifest(leaves, "lang", ["doc_id"])
    out = out.withColumn("folded_root", folded(F.coalesce("tampered", "hash"), F.col("levels")))
    return out.select(
        "doc_id", F.col("hash").alias("leaf"), "subroot", "root", proof(F.col("levels")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


def _sql(levels: int = 11) -> str:
    """The same rows for DuckDB: ``levels`` levels of languages and of the root, 8^levels leaves at most."""
    framed = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    leaf = lambda text: f"sha256({framed('doc_id')} || {framed('source')} || {framed('lang')} || {framed('n_chars')} || {framed(text)})"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    ids = "coalesce(CAST(doc_id AS VARCHAR), '')"
    steps = f"flatten(list_transform(string_split({ids}, ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))"
    crc = f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], CASE WHEN {ids} = '' THEN [] ELSE {steps} END), lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295)"
    parts = [
        f"""WITH leaves AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, count(*) OVER (PARTITION BY lang) AS n
FROM (SELECT lang, doc_id, {leaf("text")} AS leaf, CASE WHEN {crc} % 3 = 0 THEN {leaf(lower)} END AS tampered FROM documents)),
a0 AS (SELECT lang AS g, r, n, leaf AS h FROM leaves)"""
    ]

    def tree(t: str) -> None:
        around = "PARTITION BY g, r // 8 ORDER BY r ROWS BETWEEN"
        for k in range(levels):
            parts.append(
                f"""{t}s{k} AS (SELECT g, r, CASE WHEN n > 1 THEN coalesce(string_agg(h, '') OVER ({around} UNBOUNDED PRECEDING AND 1 PRECEDING), '') END AS b,
coalesce(string_agg(h, '') OVER ({around} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a FROM {t}{k}),
{t}{k + 1} AS (SELECT g, r // 8 AS r, (min(n) + 7) // 8 AS n, CASE WHEN min(n) > 1 THEN sha256(string_agg(h, '' ORDER BY r)) ELSE min(h) END AS h FROM {t}{k} GROUP BY g, r // 8)"""
            )

    def climb(t: str, source: str, start: str, out: str) -> None:
        last = source
        for k in range(levels):
            parts.append(
                f"""{out}{k} AS (SELECT l.*, CASE WHEN s.b IS NULL THEN l.f ELSE sha256(s.b || l.f || s.a) END AS f2, l.p || coalesce(s.b || s.a, '') AS p2
FROM {last} l JOIN {t}s{k} s ON s.g IS NOT DISTINCT FROM l.{start}g AND s.r = l.{start}r // {8**k}), {out}x{k} AS (SELECT * EXCLUDE (f, p, f2, p2), f2 AS f, p2 AS p FROM {out}{k})"""
            )
            last = f"{out}x{k}"

    tree("a")
    parts.append(f"b0 AS (SELECT 0 AS g, row_number() OVER (ORDER BY encode(g) NULLS FIRST) - 1 AS r, count(*) OVER () AS n, h, g AS lang FROM a{levels})")
    tree("b")
    parts.append(
        f"""start AS (SELECT doc_id, leaf, a.h AS subroot, b.h AS root, leaves.lang AS ag, leaves.r AS ar, 0 AS bg, b0.r AS br, coalesce(tampered, leaf) AS f, '' AS p
FROM leaves JOIN a{levels} a ON a.g IS NOT DISTINCT FROM leaves.lang JOIN b0 ON b0.lang IS NOT DISTINCT FROM leaves.lang CROSS JOIN b{levels} b)"""
    )
    climb("a", "start", "a", "ca")
    climb("b", f"cax{levels - 1}", "b", "cb")
    return ",\n".join(parts) + f"\nSELECT doc_id, leaf, subroot, root, sha256(p) AS proof_sha256, f AS folded_root, f = root AS verified FROM cbx{levels - 1}"


SQL = _sql()
