"""Append-only logs: JSON lines and CSV whose last line may be torn, and of which the last row of a key holds.

Spark splits the files; which line is a file's last, and whether it ended, come of one aggregate over line lengths, so no file is read by one
task. A line without its end was being written when something stopped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studyloom.storage import staged

BOM = "﻿"
#: Where a line stands: files by time and name, splits in a file, lines in a split.
POSITION = ("modified", "file", "start", "line")


def lines(spark: SparkSession, path: str) -> DataFrame:
    """position, text, first, torn of every line that isn't empty: whether it is its file's first one, and whether it is the last one
    and lacks its end. Staged, so that lines keep their positions."""
    d = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(path)
    m = F.col("_metadata")
    d = d.select(
        F.struct(m["file_modification_time"].alias("modified"), m["file_path"].alias("file"), m["file_block_start"].alias("start"), F.monotonically_increasing_id().alias("line")).alias("position"),
        F.col("value").alias("text"), m["file_size"].alias("size"),
    )
    d = staged(d, "log-lines")
    ends = d.groupBy("position.file").agg(
        # one byte more than the file has; the reader leaves out the three of a byte-order mark
        (F.sum(F.octet_length("text") + 1) - F.first("size")).isin(1, -2).alias("open"), F.max("position").alias("last"), F.min("position").alias("head")
    )
    d = d.join(ends, d["position.file"] == ends["file"])
    text = F.regexp_replace("text", "\r$", "")
    first = F.col("position") == F.col("head")
    text = F.when(first, F.regexp_replace(text, f"^{BOM}", "")).otherwise(text)
    return d.select("position", text.alias("text"), first.alias("first"), (F.col("open") & (F.col("position") == F.col("last"))).alias("torn")).where(F.trim("text") != "")


def json_log(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Rows of JSON lines with their position, and faults: lines that are no object of the schema. A torn last line that can't be parsed
    is neither; one that can be is a row, as only its end is missing."""
    d = lines(spark, path)
    row = F.from_json("text", f"{schema}, _bad string", {"columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"})
    d = staged(d.withColumn("row", row).withColumn("bad", F.col("row").isNull() | F.col("row._bad").isNotNull()), "log-rows")
    fields = [f.name for f in d.schema["row"].dataType.fields if f.name != "_bad"]
    return d.where("NOT bad").select("position", *[f"row.{f}" for f in fields]), d.where("bad AND NOT torn").select("position", "text")


def csv_log(spark: SparkSession, path: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of CSV files with a header of these columns, as text, with their position, and faults: rows of more or fewer cells, and all of a
    file with another header. A torn last line counts as not written, as its last cell may be cut. Cells hold no line ends."""
    d = lines(spark, path)
    cells = lambda text: F.from_csv(text, ", ".join(f"c{i} string" for i in range(len(columns) + 1)), {"quote": '"', "escape": '"'})
    d = d.withColumn("row", cells(F.col("text")))
    n = len(columns)
    named = F.col("first")
    for i, c in enumerate(columns):
        named = named & F.col(f"row.c{i}").eqNullSafe(F.lit(c))
    d = staged(d.withColumn("named", named & F.col(f"row.c{n}").isNull()), "log-rows")
    good = d.where("first").select(F.col("position.file").alias("file"), F.col("named").alias("good"))
    d = d.where("NOT torn").join(good, d["position.file"] == good["file"])
    whole = F.col("good") & F.col(f"row.c{n}").isNull() & (_cells(F.col("text")) == n)
    rows = d.where(whole & ~F.col("first")).select("position", *[F.coalesce(f"row.c{i}", F.lit("")).alias(c) for i, c in enumerate(columns)])
    return rows, d.where(~whole & (~F.col("first") | ~F.col("good"))).select("position", "text")


def _cells(text: Column) -> Column:
    """Cells of a CSV line: one more than the commas outside quotes. Doubled quotes open and close again."""
    return F.regexp_count(F.regexp_replace(text, '"[^"]*"', ""), F.lit(",")) + 1


def last_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The row of each key that stands last in the log, and its position."""
    held = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*held), "position").alias("_last")).select(*keys, "_last.*")


def append_json(df: DataFrame, path: str) -> None:
    """Rows as JSON lines in new files of a log."""
    df.write.mode("append").option("ignoreNullFields", False).json(path)
