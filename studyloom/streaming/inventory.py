"""Study inventory kept up to date from a stream of header rows, and counts of arrivals by time window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from studyloom.operators import headers, state
from studyloom.sources.sinks import current, publish


def inventory_rows(nh: DataFrame, version: str) -> DataFrame:
    """Header rows as the rows that ``state.upsert_studies`` merges."""
    s = headers.series_summary(nh)
    ids = nh.groupBy("study_uid").agg(
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("patient_id") != "", F.col("patient_id")))), "、").alias("patient_ids"),
        F.array_join(F.array_sort(F.collect_set("source_subject")), "|").alias("evidence"),
    )
    g = s.groupBy("study_uid").agg(
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("modalities")))), "、").alias("modalities"),
        F.min("exam_date").cast("string").alias("exam_date"), F.bool_or("is_3d").cast("int").alias("has_3d"), F.max("confidence").alias("confidence"),
        F.count(F.lit(1)).alias("series_count"), F.sum("file_count").alias("file_count"),
    )
    return g.join(ids, "study_uid").withColumn("rule_version", F.lit(version))


def keep_inventory(hdr_stream: DataFrame, root: str, checkpoint: str, version: str = headers.RULE_VERSION) -> StreamingQuery:
    """Each batch is merged into the newest snapshot and published as a new one under the batch's number; a batch that
    is run again finds its snapshot published and changes nothing."""

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        name = f"{number:012d}"
        try:
            old = current(spark, root)
            if spark.read.parquet(f"{root}/pointer").where(F.col("version") == name).limit(1).count():
                return
        except Exception as e:  # the first batch finds no snapshot
            if "PATH_NOT_FOUND" not in str(e):
                raise
            old = None
        new = inventory_rows(headers.normalised(batch), version)
        merged = state.upsert_studies(old, new).drop("action") if old is not None else new
        publish(merged, root, name)

    return hdr_stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def arrivals(events: DataFrame, time: str, every: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Counts by window and kind; rows later than the watermark are dropped by Spark."""
    w = F.window(time, every)
    return events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).groupBy(w.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(
        F.col("w.start").alias("start"), "event_type", "n", "total"
    )
