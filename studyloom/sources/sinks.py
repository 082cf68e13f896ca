"""Sinks: guarded CSV reports, and state snapshots behind a pointer."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studyloom.operators.deident import scrubbed_csv

#: Characters that a sheet's name can't hold, its greatest length, and the name of a center without one. Fixed values.
NOT_IN_SHEETS, SHEET_LENGTH, NAMELESS = r"[\\/*?:\[\]]", 31, "中心"


def write_csv(df: DataFrame, path: str) -> None:
    """A report folder that a spreadsheet can open: guarded cells, a header, never over an existing one."""
    scrubbed_csv(df).write.option("header", True).option("encoding", "UTF-8").option("quoteAll", True).mode("errorifexists").csv(path)


def publish(df: DataFrame, root: str, version: str) -> None:
    """A snapshot of a state table, then the pointer to it. A reader sees the old one or the new one, whole."""
    df.write.mode("errorifexists").parquet(f"{root}/snapshots/{version}")
    pointer = df.sparkSession.createDataFrame([(version,)], "version string")
    pointer.coalesce(1).write.mode("append").parquet(f"{root}/pointer")


def current(spark: SparkSession, root: str) -> DataFrame:
    """The snapshot with the greatest version that was published."""
    version = spark.read.schema("version string").parquet(f"{root}/pointer").agg({"version": "max"}).first()[0]
    return spark.read.parquet(f"{root}/snapshots/{version}")


def _unique(pdf: pd.DataFrame) -> pd.DataFrame:
    """Names of one block, in order: a name that is taken, whatever its case, gets the first number that makes it free."""
    taken, out = set(), []
    for name, base in pdf.sort_values("name")[["name", "base"]].itertuples(index=False):
        sheet, n = base, 1
        while sheet.casefold() in taken:
            n += 1
            end = f"_{n}"
            sheet = base[: SHEET_LENGTH - len(end)] + end
        taken.add(sheet.casefold())
        out.append((name, sheet))
    return pd.DataFrame(out, columns=["name", "sheet"])


def sheet_names(names: DataFrame) -> DataFrame:
    """names(name) -> name, sheet: a sheet's name for each distinct name, unique whatever its case. Null counts as empty,
    which gets the name of a nameless center.

    Only names of one beginning, numbers at its end aside, can meet; each such block is named by itself."""
    d = names.select(F.coalesce("name", F.lit("")).alias("name")).distinct()
    base = F.substring(F.trim(F.regexp_replace("name", NOT_IN_SHEETS, "_"), F.lit(" '")), 1, SHEET_LENGTH)
    d = d.withColumn("base", F.when(base == "", NAMELESS).otherwise(base))
    block = F.regexp_replace(F.substring(F.lower("base"), 1, 24), "(_[0-9]*)+$", "")
    return d.withColumn("block", block).groupBy("block").applyInPandas(lambda pdf: _unique(pdf), "name string, sheet string")


def write_tables(tables: dict[str, DataFrame], root: str, by: dict[str, str] | None = None) -> None:
    """A report of several tables, each a Parquet table of its own under root, never over an existing one. ``by`` names the
    column by whose values a table is dealt to folders, a center's for instance."""
    for name, df in tables.items():
        out = df.write.mode("errorifexists")
        (out.partitionBy(by[name]) if by and name in by else out).parquet(f"{root}/{name}")


def read_tables(spark: SparkSession, root: str, names: list[str]) -> dict[str, DataFrame]:
    """The tables of a report, from what was written: nothing is scanned anew."""
    return {name: spark.read.parquet(f"{root}/{name}") for name in names}
