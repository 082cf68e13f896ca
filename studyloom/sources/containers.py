"""Archives and workbooks: their members and cells as rows, parsed in tasks from bytes that Spark reads."""

from __future__ import annotations

import io
import posixpath
import re
import stat
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from studyloom.functions import text

MAX_BYTES = 1 << 32


def member_problem(info: zipfile.ZipInfo) -> str:
    """Why a member may not be extracted: empty if it may."""
    name = info.filename.replace("\\", "/")
    if name.startswith("/") or re.match("^[A-Za-z]:", name):
        return "absolute"
    if ".." in name.split("/"):
        return "parent"
    return "symlink" if stat.S_ISLNK(info.external_attr >> 16) else ""


def zip_members(spark: SparkSession, path: str, max_bytes: int = MAX_BYTES) -> DataFrame:
    """archive, member, size, content, problem: every file of every archive; content only of those without a
    problem, and of none where the whole archive would exceed max_bytes."""

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["archive", "member", "size", "content", "problem"]
        for pdf in batches:
            for archive, data in pdf[["path", "content"]].itertuples(index=False):
                try:
                    z = zipfile.ZipFile(io.BytesIO(data))
                except zipfile.BadZipFile:
                    yield pd.DataFrame([(archive, "", 0, None, "not_an_archive")], columns=columns)
                    continue
                files = [i for i in z.infolist() if not i.is_dir()]
                large = sum(i.file_size for i in files) > max_bytes
                for i in files:
                    problem = "too_large" if large else member_problem(i)
                    content = None if problem else z.read(i)
                    yield pd.DataFrame([(archive, posixpath.normpath(i.filename), i.file_size, content, problem)], columns=columns)

    d = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.zip").load(path)
    return d.select("path", "content").mapInPandas(members, "archive string, member string, size long, content binary, problem string")


_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships"}


def _column(ref: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def sheet_rows(data: bytes) -> Iterator[tuple[str, int, list[str]]]:
    """(sheet, row number, cells) of a workbook; a missing cell is empty."""
    z = zipfile.ZipFile(io.BytesIO(data))
    names = set(z.namelist())
    shared = []
    if "xl/sharedStrings.xml" in names:
        shared = ["".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", _NS)]
    targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
    for sheet in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{{{_NS['m']}}}sheet"):
        target = targets[sheet.get(f"{{{_NS['r']}}}id")]
        part = target.lstrip("/") if target.startswith("/") else posixpath.normpath(f"xl/{target}")
        for row in ElementTree.fromstring(z.read(part)).iter(f"{{{_NS['m']}}}row"):
            cells: list[str] = []
            for c in row.findall("m:c", _NS):
                at, value = _column(c.get("r")), c.findtext("m:v", "", _NS)
                if c.get("t") == "s" and value:
                    value = shared[int(value)]
                elif c.get("t") == "inlineStr":
                    value = "".join(t.text or "" for t in c.iter(f"{{{_NS['m']}}}t"))
                cells += [""] * (at + 1 - len(cells))
                cells[at] = value
            yield sheet.get("name"), int(row.get("r")), cells


def workbook_rows(spark: SparkSession, path: str) -> DataFrame:
    """workbook, sheet, row, cells of every workbook below a path."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, data in pdf[["path", "content"]].itertuples(index=False):
                yield pd.DataFrame([(name, *r) for r in sheet_rows(data)], columns=["workbook", "sheet", "row", "cells"])

    d = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.xls[xm]").load(path)
    return d.select("path", "content").mapInPandas(rows, "workbook string, sheet string, row int, cells array<string>")


def as_table(rows: DataFrame, required: list[str], aliases: dict[str, str] | None = None, within: int = 20) -> DataFrame:
    """workbook, sheet, __row__ and a column per required header: the header row of a sheet is the first of its first
    rows that has them all, by key or alias; rows before it and sheets without one give nothing."""
    names = {shown: name for name in required for shown in (name, *[a for a, r in (aliases or {}).items() if r == name])}
    keyed = F.transform("cells", lambda c: text.header_key(c))
    where = F.array(*[
        F.coalesce(*[F.nullif(F.array_position(keyed, text.header_key(F.lit(n))), F.lit(0)) for n, r in names.items() if r == want]) for want in required
    ])
    heads = rows.where(F.col("row") <= within).withColumn("at", where).where(~F.exists("at", lambda a: a.isNull()))
    heads = heads.groupBy("workbook", "sheet").agg(F.min(F.struct("row", "at")).alias("head"))
    d = rows.join(heads, ["workbook", "sheet"]).where(F.col("row") > F.col("head.row"))
    cells = [F.coalesce(F.get("cells", (F.col("head.at")[i] - 1).cast("int")), F.lit("")).alias(n) for i, n in enumerate(required)]
    return d.select("workbook", "sheet", F.col("row").alias("__row__"), *cells)


def repeated_blocks(rows: DataFrame, required: list[str], optional: list[str] = [], order: str = "#") -> DataFrame:  # noqa: B006
    """Wide sheets, whose header repeats its columns side by side, as long rows: workbook, sheet, block (from 1), __row__, __order__, and a
    column for each required and optional header.

    The header row of a sheet is its first row that has all required headers; it has as many blocks as the rarest of them has places,
    and a block takes the n-th place of each. Rows of a block in which all cells are empty are none; the order is what the block's
    ``order`` column says, else how far the row is below the header."""
    keyed = F.transform("cells", lambda c: text.header_key(c))
    places = lambda name: F.filter(F.transform(keyed, lambda c, i: F.when(c == text.header_key(F.lit(name)), i)), lambda i: i.isNotNull())
    wanted = [*required, *optional, order]
    heads = rows.select("workbook", "sheet", "row", F.array(*[places(n) for n in wanted]).alias("at"))
    count = F.array_min(F.transform(F.slice("at", 1, len(required)), lambda a: F.size(a)))
    heads = heads.withColumn("blocks", count).where("blocks > 0").groupBy("workbook", "sheet").agg(F.min(F.struct("row", "at", "blocks")).alias("head"))
    d = rows.join(heads, ["workbook", "sheet"]).where(F.col("row") > F.col("head.row"))
    d = d.select("workbook", "sheet", "row", "cells", "head", F.explode(F.sequence(F.lit(1), F.col("head.blocks"))).alias("block"))
    cell = lambda k: F.trim(F.coalesce(F.get("cells", F.get(F.col("head.at")[k], F.col("block") - 1)), F.lit("")))
    named = [cell(k).alias(n) for k, n in enumerate(wanted[:-1])]
    at = F.coalesce(F.floor(cell(len(wanted) - 1).try_cast("double")).cast("int"), F.col("row") - F.col("head.row"))
    d = d.select("workbook", "sheet", "block", F.col("row").alias("__row__"), at.alias("__order__"), *named)
    return d.where(F.concat(*[F.col(f"`{n}`") for n in wanted[:-1]]) != "")


def differing_blocks(long: DataFrame, columns: list[str]) -> DataFrame:
    """(workbook, sheet, block) of blocks whose rows, in their order, are not those of the sheet's first block. Nothing of such a sheet is to be
    used before someone has looked at it. Row k of all blocks meets in one group, so no block is compared as a whole."""
    place = F.row_number().over(W.partitionBy("workbook", "sheet", "block").orderBy("__row__"))
    sign = F.sha2(F.array_join(F.array(*[F.concat(F.length(F.col(f"`{c}`").cast("string")).cast("string"), F.lit(":"), F.col(f"`{c}`").cast("string")) for c in columns]), "|"), 256)
    d = long.select("workbook", "sheet", "block", place.alias("place"), sign.alias("sign"))
    g = d.groupBy("workbook", "sheet", "place").agg(F.max(F.when(F.col("block") == 1, F.col("sign"))).alias("first"), F.collect_list(F.struct("block", "sign")).alias("all"))
    g = g.select("workbook", "sheet", "place", "first", F.explode("all").alias("b"))
    other = g.where((F.col("b.block") > 1) & ~F.col("b.sign").eqNullSafe(F.col("first"))).select("workbook", "sheet", F.col("b.block").alias("block"))
    size = long.groupBy("workbook", "sheet", "block").agg(F.count(F.lit(1)).alias("n"))
    longest = size.where("block = 1").select("workbook", "sheet", F.col("n").alias("first_n"))
    shorter = size.join(longest, ["workbook", "sheet"], "left").where("block > 1 AND NOT n <=> first_n").select("workbook", "sheet", "block")
    return other.union(shorter).distinct()
