"""Files: where they go, copies and conflicts, selection rules, listings, and what need not be read again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from studyloom.functions import domain, text


def destination(folder: Column) -> Column:
    """Target of a file: folder, Study, Series, instance; files that lack an identifier go to quarantine."""
    whole = (F.col("study_uid") != "") & (F.col("series_uid") != "") & (F.col("sop_uid") != "")
    target = F.concat_ws("/", text.path_component(folder), "study_uid", "series_uid", F.concat("sop_uid", F.lit(".dcm")))
    return F.when(whole, target).otherwise(F.concat_ws("/", F.lit("_quarantine"), F.concat(text.path_hash(F.col("relative_path")), F.lit(".dcm"))))


def copy_status(files: DataFrame) -> DataFrame:
    """files(relative_path, target, sha) with status and final_target. In path order the first of a target is copied;
    the same bytes again are duplicates; other bytes are conflicts, kept beside it under their hash, once each."""
    by_path = W.partitionBy("target").orderBy("relative_path")
    d = files.withColumn("first_sha", F.first("sha").over(by_path)).withColumn("nth", F.row_number().over(W.partitionBy("target", "sha").orderBy("relative_path")))
    same = F.col("sha") == F.col("first_sha")
    status = F.when(F.col("target").startswith("_quarantine/"), "quarantined").when(F.col("nth") > 1, "duplicate_same").when(same, "copied").otherwise("conflict")
    beside = F.concat(F.regexp_replace("target", r"\.dcm$", "."), F.substring("sha", 1, 12), F.lit(".conflict.dcm"))
    return d.withColumn("status", status).withColumn("final_target", F.when(same, F.col("target")).otherwise(beside)).drop("first_sha", "nth")


def rule_issue(level: Column, series_uid: Column, sop_uid: Column) -> Column:
    """Why a selection rule can't be used: empty if it can."""
    uid = F.when(level == "series", series_uid).when(level == "sop", sop_uid)
    bad = lambda c: F.size(domain.uid_reasons(c)) > 0
    return F.concat_ws(",", F.when(uid.isNull(), "level"), F.when(uid == "", "missing_uid"), F.when((uid != "") & bad(uid), "uid"))


def apply_rules(rules: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rules(rule, level, series_uid, sop_uid) -> (rule, relative_path), and rules with status: ignored duplicates,
    invalid ones, those that hit nothing, and matched ones with their files. Two equi-joins, one per level."""
    first = W.partitionBy("level", "series_uid", "sop_uid").orderBy("rule")
    r = rules.withColumn("issue", rule_issue(F.col("level"), F.col("series_uid"), F.col("sop_uid"))).withColumn("nth", F.row_number().over(first))
    usable = r.where("issue = '' AND nth = 1")
    f = files.select("relative_path", "series_uid", "sop_uid")
    hits = (
        usable.where("level = 'series'").select("rule", "series_uid").join(f, "series_uid").select("rule", "relative_path")
        .union(usable.where("level = 'sop'").select("rule", "sop_uid").join(f, "sop_uid").select("rule", "relative_path"))
    )
    n = hits.groupBy("rule").agg(F.count(F.lit(1)).alias("files"))
    status = F.when(F.col("issue") != "", "invalid_selection_rule").when(F.col("nth") > 1, "duplicate_rule_ignored").when(F.col("files").isNull(), "uid_not_found").otherwise("planned")
    return hits, r.join(n, "rule", "left").select("rule", status.alias("status"), F.coalesce("files", F.lit(0)).alias("files"))


def block_groups(files: DataFrame, key: str, bad: Column) -> DataFrame:
    """One bad file blocks all of its group."""
    blocked = files.where(bad).select(key).distinct().withColumn("_blocked", F.lit(True))
    d = files.join(blocked, key, "left")
    return d.withColumn("status", F.when(bad, "invalid").when(F.col("_blocked"), "blocked_by_rule_validation").otherwise("planned")).drop("_blocked")


def locate(plans: DataFrame, directories: DataFrame) -> DataFrame:
    """plans(study_uid) and directories(study_uid, path): the only directory of a Study, else missing or duplicate."""
    g = directories.groupBy("study_uid").agg(F.count(F.lit(1)).alias("n"), F.min("path").alias("path"))
    d = plans.join(g, "study_uid", "left")
    status = F.when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "duplicate").otherwise("located")
    return d.withColumn("status", status).withColumn("path", F.when(status == "located", F.col("path"))).drop("n")


def to_scan(listing: DataFrame, cache: DataFrame) -> DataFrame:
    """listing(path, size, modified) with whether the cached scan of the same size and time can be used."""
    c = cache.select("path", F.col("size").alias("_size"), F.col("modified").alias("_modified"))
    d = listing.join(c, "path", "left")
    same = (F.col("size") == F.col("_size")) & (F.col("modified") == F.col("_modified"))
    action = F.when(same, "reuse").when(F.col("_size").isNull(), "new").otherwise("changed")
    return d.withColumn("action", action).drop("_size", "_modified")


def to_resume(work: DataFrame, checkpoint: DataFrame, contexts: list[str]) -> DataFrame:
    """work(source, target, source_size, target_size) with whether the last checkpoint row of the pair still holds:
    written under an accepted context, and neither side has changed."""
    last = checkpoint.groupBy("source", "target").agg(F.max(F.struct("at", "context", "source_size", "target_size")).alias("c"))
    d = work.join(last, ["source", "target"], "left")
    holds = F.col("c.context").isin(*contexts) & (F.col("c.source_size") == F.col("source_size")) & (F.col("c.target_size") == F.col("target_size"))
    return d.withColumn("resume", F.coalesce(holds, F.lit(False))).drop("c")


def run_status(results: DataFrame, group: str) -> DataFrame:
    """Per group: files by outcome, and whether the group is complete, needs attention or failed."""
    n = lambda *s: F.count(F.when(F.col("status").isin(*s), 1))
    g = results.groupBy(group).agg(
        F.count(F.lit(1)).alias("files"), n("copied").alias("copied"), n("duplicate_same").alias("duplicates"), n("conflict").alias("conflicts"), n("quarantined", "error").alias("rejected")
    )
    ended = F.when(F.col("copied") == 0, "failed").when((F.col("conflicts") > 0) | (F.col("rejected") > 0), "needs_attention").otherwise("complete")
    return g.withColumn("run_status", ended)


def verify_candidates(files: DataFrame, expected: DataFrame) -> DataFrame:
    """files(relative_path, study_uid, series_uid, sop_uid, file_size, modified) as read, expected(relative_path, the
    same) as planned: status ok, source_file_missing, source_changed or uid_mismatch with the identifiers that differ."""
    f, e = files.alias("f"), expected.alias("e")
    d = e.join(f, F.col("e.relative_path") == F.col("f.relative_path"), "left")
    differ = F.array_compact(F.array(*[F.when(F.col(f"e.{c}") != F.col(f"f.{c}"), c) for c in ("study_uid", "series_uid", "sop_uid")]))
    changed = (F.col("e.file_size") != F.col("f.file_size")) | (F.col("e.modified") != F.col("f.modified"))
    status = F.when(F.col("f.relative_path").isNull(), "source_file_missing").when(changed, "source_changed").when(F.size(differ) > 0, "uid_mismatch").otherwise("ok")
    return d.select("e.relative_path", status.alias("status"), F.when(status == "uid_mismatch", F.array_join(differ, ",")).otherwise("").alias("differ"))


def publish_status(verified: DataFrame, existing: DataFrame, execute: bool) -> DataFrame:
    """verified(target, sha, problems), existing(target, sha) -> what a run does with each file: nothing where it did
    not pass, a duplicate where the target has its bytes, a conflict where it has others, else it writes."""
    e = existing.select("target", F.col("sha").alias("_sha"))
    d = verified.join(e, "target", "left")
    status = (
        F.when(F.col("problems") != "", "verification_failed").when(F.col("_sha") == F.col("sha"), "duplicate_same").when(F.col("_sha").isNotNull(), "conflict")
        .otherwise("written" if execute else "planned")
    )
    return d.withColumn("status", status).drop("_sha")
