"""Listings and the files that a scan leaves out. Spark lists the files, so any store that it reads will do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Names and endings of files that are no images. Fixed values.
SKIPPED_SUFFIXES = ("7z", "csv", "db", "doc", "docx", "ini", "json", "log", "pdf", "rar", "tar", "txt", "xls", "xlsx", "xml", "zip")
#: Folders of a tool's own output that a scan of transferred files leaves out, and pictures, which are no headers. Fixed values.
OWN_FOLDERS = (".dicom_v3_state", "_quarantine", "_identity_review", "logs", "outputs")
PICTURES = ("jpeg", "jpg", "png")
ARCHIVES = ("7z", "rar", "tar", "zip")


def listing(spark: SparkSession, root: str) -> DataFrame:
    """path, size, modified of every file below a folder, without reading any."""
    d = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return d.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def relative(path: Column, root: str) -> Column:
    bare = F.regexp_replace(path, "^[a-z0-9]+:/+", "/")
    return F.regexp_replace(bare, "^" + "".join("\\" + c if not c.isalnum() else c for c in root.split("://")[-1].rstrip("/")) + "/?", "")


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))


def transferred(files: DataFrame, root: str) -> DataFrame:
    """Files of a center's folder that may be headers: none in a hidden folder or in one of OWN_FOLDERS, however deep, and no report or
    picture. Folders above the root may have any name."""
    folders = F.slice(F.split(relative(F.col("path"), root), "/"), 1, F.greatest(F.size(F.split(relative(F.col("path"), root), "/")) - 1, F.lit(0)))
    own = F.exists(folders, lambda x: x.isin(*OWN_FOLDERS) | x.startswith("."))
    return files.where(~own & ~suffix(F.col("path")).isin("csv", "json", "log", "xls", "xlsx", *PICTURES))


def sources(files: DataFrame, exclude: str | None = None) -> DataFrame:
    """Files that may be images: none below ``exclude``, no hidden folder, no DICOMDIR, no other kind of file."""
    name = F.substring_index("path", "/", -1)
    keep = ~F.col("path").rlike(r"/\.[^/]") & (F.upper(name) != "DICOMDIR") & ~suffix(F.col("path")).isin(*SKIPPED_SUFFIXES)
    if exclude:
        keep = keep & ~F.regexp_replace("path", "^[a-z0-9]+:/+", "/").startswith(exclude.split("://")[-1].rstrip("/") + "/")
    return files.where(keep)


def archives(files: DataFrame) -> DataFrame:
    return files.where(suffix(F.col("path")).isin(*ARCHIVES))


def packages(relative_path: Column) -> Column:
    """struct<group, package>: the screening number that a first path component begins with, and the component."""
    first = F.split_part(relative_path, F.lit("/"), F.lit(1))
    return F.struct(F.upper(F.regexp_replace(F.regexp_extract(first, r"^([0-9]{2}[-_][HhQq][0-9]{3})", 1), "_", "-")).alias("group"), first.alias("package"))


def path_list(spark: SparkSession, path: str) -> DataFrame:
    """Paths of a text file, one a line: without byte-order mark, carriage returns and trailing blanks."""
    d = spark.read.text(path).select(F.rtrim(F.regexp_replace("value", "[﻿\r]", "")).alias("path"))
    return d.where("path <> ''")
