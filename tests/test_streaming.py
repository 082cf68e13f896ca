from pyspark.sql import functions as F

from studyloom.operators import headers as H
from studyloom.plans.adapters import hdr
from studyloom.sources.sinks import current
from studyloom.streaming import inventory

SF = "/root/testdata/sf0.001"


def test_inventory_follows_batches(spark, tmp_path):
    rows = hdr(spark, SF).where("patient_id_raw <> ''")
    src = f"{tmp_path}/in"
    for k in range(2):
        rows.where(F.abs(F.xxhash64("relative_path")) % 2 == k).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = inventory.keep_inventory(stream, f"{tmp_path}/state", f"{tmp_path}/checkpoint")
    q.awaitTermination()
    got = current(spark, f"{tmp_path}/state")
    want = inventory.inventory_rows(H.normalised(rows), H.RULE_VERSION)
    keep = ["study_uid", "patient_ids", "modalities", "exam_date"]
    assert sorted(map(tuple, got.select(keep).collect())) == sorted(map(tuple, want.select(keep).collect()))


def test_arrivals(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    events.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"{tmp_path}/in")
    q = inventory.arrivals(stream, "ts", late="3650 days").writeStream.format("memory").queryName("arrived").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("arrived").agg(F.sum("n")).first()[0] == events.count()
