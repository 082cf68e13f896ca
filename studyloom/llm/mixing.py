"""Operator 1: mixing sources to target weights by weighted fair queueing.

Every source's documents stand in a shuffled queue, which is played up to ``repeats`` times. A copy's virtual
finish time is the source's tokens up to and with it, divided by the source's target; the copies of all sources
in the order of finish times are the mix, cut where the total budget is spent. At time 1 every source has spent
its target, so each prefix of the mix has the target proportions.

Nothing gathers a source in one task. The queue positions are a two-level prefix sum: rows are dealt to buckets by
source and shuffle-hash range, a window runs inside a bucket, and bucket totals carry the offsets. The mix is range-
sorted by finish time; the totals of its ranges tell in which one the budget ends, and a running sum inside that range
where.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from studyloom.llm.common import WORD, table
from studyloom.storage import staged

#: Mean rows of a bucket of the shuffled queues, and how many buckets a source may have, whose totals one task sums;
#: mean copies of a range of the sorted mix.
BUCKET_ROWS, MAX_BUCKETS, RANGE_ROWS = 256, 1 << 20, 1 << 18


def shuffle_key(doc_id: Column) -> Column:
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: tuple[int, int], repeats: int) -> DataFrame:
    """sizes(source, source_size) with srank, target: ``share`` of the total by weight, filled up like water to
    at most ``repeats`` times a source's size. Sorted by cap over weight, the full sources are a prefix."""
    everything = W.partitionBy()
    cycle = F.array(*[F.lit(w) for w in weights])
    d = (
        sizes.withColumn("srank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())).cast("long"))
        .withColumn("w", F.element_at(cycle, ((F.col("srank") - 1) % len(weights) + 1).cast("int")).cast("long"))
        .withColumn("cap", F.col("source_size") * repeats)
        .withColumn("budget", F.sum("source_size").over(everything) * share[0] / F.lit(share[1]))
    )
    order = W.orderBy(F.col("cap") / F.col("w"), "srank")
    d = (
        d.withColumn("before", F.coalesce(F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("rest", F.sum("w").over(order.rowsBetween(0, W.unboundedFollowing)))
        .withColumn("at", F.row_number().over(order))
        .withColumn("level", (F.col("budget") - F.col("before")) / F.col("rest"))
    )
    level = F.min(F.when(F.col("cap") / F.col("w") >= F.col("level"), F.struct("at", "level"))).over(everything)["level"]
    return d.select("source", "source_size", "srank", F.least(F.col("cap").cast("double"), level * F.col("w")).alias("target"))


def queued(docs: DataFrame, weights: tuple[int, ...], share: tuple[int, int], repeats: int) -> tuple[DataFrame, int]:
    """docs(doc_id, source, size) with source_size, srank, target and cum: the source's tokens up to and with the
    row in the shuffled queue. Also the total of all sizes. Ties of the hash are broken by id and size."""
    docs = staged(docs.select("doc_id", "source", "size"), "mix-sizes")
    n, total = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    buckets = min(MAX_BUCKETS, max(1, n // BUCKET_ROWS))
    key = shuffle_key(F.col("doc_id"))
    d = docs.withColumn("key", key).withColumn(
        "bucket", F.shiftright(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * buckets, 32)
    )
    targets = source_targets(docs.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, repeats)
    before = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        d.groupBy("source", "bucket")
        .agg(F.sum("size").alias("held"))
        .withColumn("offset", F.coalesce(F.sum("held").over(before), F.lit(0)))
        .alias("o")
        .join(targets.alias("t"), F.col("o.source").eqNullSafe(F.col("t.source")))
        .select("o.source", "bucket", "offset", "source_size", "srank", "target")
    )
    inside = W.partitionBy("source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    d = d.withColumn("inside", F.sum("size").over(inside)).alias("d")
    joined = d.join(offsets.alias("f"), F.col("d.source").eqNullSafe(F.col("f.source")) & (F.col("d.bucket") == F.col("f.bucket")))
    return joined.select(
        "d.doc_id", "d.source", "d.size", "f.source_size", "f.srank", "f.target", (F.col("offset") + F.col("inside")).alias("cum")
    ), total


def finish(copy: int) -> Column:
    """Virtual finish time of a row's copy: null where nothing is to be taken."""
    return F.when((F.col("size") > 0) & (F.col("target") > 0), (F.col("source_size") * copy + F.col("cum")) / F.col("target"))


def find_cut(queue: DataFrame, budget: int, repeats: int) -> tuple[float, int, int] | None:
    """(finish time, source rank, tokens left for it) of the copy in which the budget ends; None: all is taken."""
    copies = queue.select("srank", "size", F.explode(F.array(*[finish(c) for c in range(repeats)])).alias("v"))
    copies = copies.where(F.col("v").isNotNull())
    rows, total = copies.agg(F.count(F.lit(1)), F.sum("size")).first()
    if not rows or total <= budget:
        return None
    ranges = -(-rows // RANGE_ROWS)
    line = copies.repartitionByRange(ranges, "v", "srank").sortWithinPartitions("v", "srank")
    line = staged(line.withColumn("range", F.spark_partition_id()), "mix-line")
    earlier = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    held = line.groupBy("range").agg(F.sum("size").alias("held")).withColumn("spent", F.coalesce(F.sum("held").over(earlier), F.lit(0)))
    range_, spent = held.where((F.col("spent") < budget) & (F.col("spent") + F.col("held") >= budget)).select("range", "spent").first()
    so_far = F.sum("size").over(W.orderBy("v", "srank").rowsBetween(W.unboundedPreceding, 0))
    inside = line.where(F.col("range") == range_).withColumn("end", so_far + spent)
    last = inside.where(F.col("end") >= budget).orderBy("v", "srank").first()
    return last.v, last.srank, budget - (last.end - last.size)


def mix(
    docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: tuple[int, int] = (3, 2), repeats: int = 2
) -> DataFrame:
    """docs(doc_id, source, size) -> doc_id, source, size, source_size, target, taken, copies.

    taken: tokens of the document that the mix takes over all its copies; the last copy may be cut short. copies:
    how many of its copies begin within the mix. Empty documents take nothing; a null source is a source; repeated
    rows queue one after the other; an empty table gives an empty result."""
    queue, total = queued(docs, weights, share, repeats)
    queue = staged(queue, "mix-queue")
    budget = total * share[0] // share[1]
    cut = find_cut(queue, budget, repeats) if budget else (float("-inf"), 0, 0)
    taken, copies = F.lit(0).cast("long"), F.lit(0)
    for c in range(repeats):
        v = finish(c)
        if cut is None:
            whole, part = v.isNotNull(), F.lit(0)
        else:
            at = (v == cut[0]) & (F.col("srank") == cut[1])
            whole = (v < cut[0]) | ((v == cut[0]) & (F.col("srank") < cut[1]))
            part = F.when(at, F.lit(cut[2])).otherwise(0)
        got = F.when(whole, F.col("size")).otherwise(part)
        taken, copies = taken + got, copies + (got > 0).cast("int")
    return queue.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), copies.alias("copies"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def mixed(docs: DataFrame, text: str = "text", **how) -> DataFrame:
    """docs with each row once for every copy of it that begins within the mix, all its columns as they are, whatever
    their names. Rows with one id, source and size stand for each other: the copies that the mix takes of them are
    dealt out in the order of the text's hash, so what is kept is the same in every run. Rows without words (null and
    empty texts among them) go; null ids and sources are values like others; no documents give no documents."""
    repeats = how.get("repeats", 2)
    rows = docs.select(F.struct("*").alias("doc"), "doc_id", "source", word_count(F.col(text)).alias("size"), F.xxhash64(text).alias("hash"))
    taken = mix(rows.select("doc_id", "source", "size"), **how).where("copies > 0")
    key = F.xxhash64("doc_id", "source", "size").alias("key")
    taken = taken.groupBy(key).agg(*[F.sum((F.col("copies") >= c).cast("int")).alias(f"rows{c}") for c in range(1, repeats + 1)])
    rows = rows.select("doc", "hash", key).withColumn("at", F.row_number().over(W.partitionBy("key").orderBy("hash")))
    copies = sum(((F.col("at") <= F.col(f"rows{c}")).cast("int") for c in range(1, repeats + 1)), F.lit(0))
    rows = rows.join(taken, "key").withColumn("copies", copies).where("copies > 0")
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc.*")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with what the mix takes of it. A null text has size 0, of which nothing is taken; a null source is
    a source; null ids and repeated rows queue like others; extra columns do not matter; an empty table gives an empty
    result."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS srank FROM s),
w AS (SELECT *, CAST([3, 1, 2][(srank - 1) % 3 + 1] AS BIGINT) AS w, source_size * 2 AS cap,
      CAST(sum(source_size) OVER () * 3 AS DOUBLE) / 2 AS budget FROM r),
l AS (SELECT *, row_number() OVER o AS pos, (budget - CAST(coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
      / CAST(sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
      FROM w WINDOW o AS (ORDER BY cap / w, srank)),
t AS (SELECT source, source_size, srank, least(CAST(cap AS DOUBLE),
      (SELECT level FROM l WHERE cap / w >= level ORDER BY pos LIMIT 1) * w) AS target FROM l),
q AS (SELECT d.doc_id, d.size, t.source_size, t.srank, t.target, sum(d.size) OVER (PARTITION BY t.srank
      ORDER BY md5(coalesce(CAST(d.doc_id AS VARCHAR), '')), d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS cum,
      row_number() OVER () AS row FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT row, size, srank, CAST(cum AS DOUBLE) / target AS v FROM q WHERE size > 0
      UNION ALL SELECT row, size, srank, CAST(source_size + cum AS DOUBLE) / target FROM q WHERE size > 0),
g AS (SELECT row, size, sum(size) OVER (ORDER BY v, srank ROWS UNBOUNDED PRECEDING) AS past FROM c),
b AS (SELECT CAST(sum(size) * 3 // 2 AS BIGINT) AS budget FROM d),
k AS (SELECT row, sum(greatest(0, least(size, budget - (past - size)))) AS taken FROM g, b GROUP BY row)
SELECT q.doc_id, q.size, q.source_size, q.target, CAST(coalesce(k.taken, 0) AS BIGINT) AS taken FROM q LEFT JOIN k USING (row)
"""
