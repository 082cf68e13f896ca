"""Imaging headers: a reader of tagged files that stops before the pixels.

Spark lists the files, tasks read them by range and parse what they read. A file that can't be parsed is a row with an error, never a failed job.
"""

from __future__ import annotations

import hashlib
import io
import struct
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studyloom.sources.listing import sources

# Tags by keyword that headers are read for. Fixed values of the format.
TAGS = {
    "AcquisitionDate": 0x00080022, "ImageType": 0x00080008, "InstitutionName": 0x00080080, "Manufacturer": 0x00080070, "ManufacturerModelName": 0x00081090,
    "Modality": 0x00080060, "NumberOfFrames": 0x00280008, "PatientAge": 0x00101010, "PatientBirthDate": 0x00100030, "PatientID": 0x00100020,
    "PatientName": 0x00100010, "PatientSex": 0x00100040, "SeriesDate": 0x00080021, "SeriesDescription": 0x0008103E, "SeriesInstanceUID": 0x0020000E,
    "SliceThickness": 0x00180050, "SOPClassUID": 0x00080016, "SOPInstanceUID": 0x00080018, "StudyDate": 0x00080020, "StudyInstanceUID": 0x0020000D,
}
# Further tags that de-identification and verification know by keyword, and the kinds of those that implicit data leave unsaid.
# Fixed values of the format.
MORE_TAGS = {
    "AccessionNumber": 0x00080050, "AcquisitionTime": 0x00080032, "AdditionalPatientHistory": 0x001021B0, "ContentDate": 0x00080023, "ContentTime": 0x00080033,
    "DeviceSerialNumber": 0x00181000, "FrameOfReferenceUID": 0x00200052, "ImageComments": 0x00204000, "InstitutionAddress": 0x00080081,
    "InstitutionalDepartmentName": 0x00081040, "IssuerOfPatientID": 0x00100021, "OperatorsName": 0x00081070, "OtherPatientIDs": 0x00101000,
    "PatientAddress": 0x00101040, "PatientBirthTime": 0x00100032, "PatientComments": 0x00104000, "PerformingPhysicianName": 0x00081050,
    "ProtocolName": 0x00181030, "ReferencedSOPClassUID": 0x00081150, "ReferencedSOPInstanceUID": 0x00081155, "ReferringPhysicianName": 0x00080090,
    "RequestedProcedureDescription": 0x00321060, "SeriesTime": 0x00080031, "StationName": 0x00081010, "StudyDescription": 0x00081030, "StudyID": 0x00200010,
    "StudyTime": 0x00080030, "TextString": 0x20300020, "TargetUID": 0x00182042, "TrackingUID": 0x00620021,
}
KEYWORDS = {tag: keyword for keyword, tag in (TAGS | MORE_TAGS).items()}


def kind_of(keyword: str) -> bytes:
    """The kind of a known tag's value by the ending of its keyword; a text where no ending says more."""
    for ending, vr in (("UID", b"UI"), ("Date", b"DA"), ("Time", b"TM"), ("PatientName", b"PN"), ("sName", b"PN"), ("PhysicianName", b"PN"), ("Age", b"AS"), ("Sex", b"CS"), ("Modality", b"CS"), ("ImageType", b"CS")):
        if keyword.endswith(ending):
            return vr
    return b"IS" if keyword == "NumberOfFrames" else b"DS" if keyword == "SliceThickness" else b"LO"


VRS = {tag: kind_of(keyword) for tag, keyword in KEYWORDS.items()}
PIXELS, ITEM, ITEM_END, SEQUENCE_END, UNDEFINED = 0x7FE00010, 0xFFFEE000, 0xFFFEE00D, 0xFFFEE0DD, 0xFFFFFFFF
IMPLICIT_LE, EXPLICIT_LE = "1.2.840.10008.1.2", "1.2.840.10008.1.2.1"
LONG_VRS = frozenset((b"OB", b"OD", b"OF", b"OL", b"OV", b"OW", b"SQ", b"SV", b"UC", b"UN", b"UR", b"UT", b"UV"))
BULK_VRS = frozenset((b"OB", b"OD", b"OF", b"OL", b"OV", b"OW", b"UN"))
#: Bytes of the longest binary value, and of the longest value at all, that a row holds; files of a task.
MAX_BINARY, MAX_VALUE, FILES_PER_TASK = 1 << 12, 1 << 24, 1024
BINARY = {b"US": "<H", b"SS": "<h", b"UL": "<I", b"SL": "<i", b"FL": "<f", b"FD": "<d"}


class Ranged:
    """Bytes of an open file by place, fetched a window at a time, so that what nobody asks for is never read."""

    def __init__(self, file, size: int, window: int = 1 << 14):
        self.file, self.size, self.window = file, size, window
        self.start, self.held, self.fetched = 0, b"", 0

    def get(self, at: int, n: int) -> bytes:
        """At most n bytes: less where the file ends."""
        n = max(0, min(n, self.size - at))
        if at < self.start or at + n > self.start + len(self.held):
            self.file.seek(at)
            self.start, self.held = at, self.file.read(max(n, min(self.window, self.size - at)))
            self.fetched += len(self.held)
        return self.held[at - self.start : at - self.start + n]


class Element(NamedTuple):
    path: str
    tag: int
    vr: bytes
    raw: bytes | None  # None: bulk, which was passed over
    at: int  # where the value begins
    length: int


def elements(src: Ranged, at: int, explicit: bool, stop: int | None = None, root: str = "root") -> Iterator[Element]:
    """The elements from a place on, depth first, sequences before their items; nested ones carry their sequence's place in their
    path. Sequences and items of undefined length end at their delimiters. Long binary values and encapsulated pixels are passed over
    by their lengths. Ends before the first tag at ``stop`` or beyond on the outermost level."""
    frames: list[list] = [[src.size, root, False, 0, explicit]]  # end or None, path, whether of items, items so far, explicit
    while frames:
        end, path, items, n, explicit = frames[-1]
        limit = next(f[0] for f in reversed(frames) if f[0] is not None)
        if at + 8 > limit:
            frames.pop()
            continue
        head = src.get(at, 12)
        tag = int.from_bytes(head[:2], "little") << 16 | int.from_bytes(head[2:4], "little")
        if items or tag in (ITEM, ITEM_END, SEQUENCE_END):
            size = int.from_bytes(head[4:8], "little")
            at += 8
            if items and tag == ITEM:
                frames[-1][3] += 1
                frames.append([None if size == UNDEFINED else at + size, f"{path}[{n}]", False, 0, explicit])
            elif (items and tag == SEQUENCE_END) or (not items and tag == ITEM_END and len(frames) > 1):
                frames.pop()
            else:
                raise ValueError(f"{tag:08x} out of place")
            continue
        if len(frames) == 1 and stop is not None and tag >= stop:
            return
        vr = head[4:6] if explicit else b""
        if explicit and vr in LONG_VRS:
            size, body = int.from_bytes(head[8:12], "little"), at + 12
        elif explicit:
            size, body = int.from_bytes(head[6:8], "little"), at + 8
        else:
            size, body = int.from_bytes(head[4:8], "little"), at + 8
        undefined = size == UNDEFINED
        if undefined and (tag == PIXELS or vr in BULK_VRS - {b"UN"}):
            at = fragments_end(src, body, limit)
            yield Element(path, tag, vr, None, body, at - body)
        elif vr == b"SQ" or undefined or (not explicit and size >= 8 and src.get(body, 4) == b"\xfe\xff\x00\xe0"):
            yield Element(path, tag, b"SQ", b"", body, size)
            # what an unknown sequence holds is implicit whatever stands around it
            frames.append([None if undefined else body + size, f"{path}/{tag:08x}", True, 0, explicit and vr != b"UN"])
            at = body
        else:
            if body + size > limit:
                raise ValueError(f"element {tag:08x} runs past the end")
            bulk = tag == PIXELS or (vr in BULK_VRS or not vr) and size > MAX_BINARY or size > MAX_VALUE
            yield Element(path, tag, vr, None if bulk else src.get(body, size), body, size)
            at = body + size


def fragments_end(src: Ranged, at: int, limit: int) -> int:
    """Behind the delimiter that ends encapsulated pixels."""
    while at + 8 <= limit:
        head = src.get(at, 8)
        tag, size = int.from_bytes(head[:2], "little") << 16 | int.from_bytes(head[2:4], "little"), int.from_bytes(head[4:], "little")
        at += 8
        if tag == SEQUENCE_END:
            return at
        if tag != ITEM or size == UNDEFINED:
            raise ValueError(f"{tag:08x} among fragments")
        at += size
    raise ValueError("fragments run past the end")


def text_of(vr: bytes, raw: bytes) -> str:
    if vr in BINARY and raw:
        form = BINARY[vr]
        width = struct.calcsize(form)
        return "\\".join(str(struct.unpack_from(form, raw, i)[0]) for i in range(0, len(raw) - width + 1, width))
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError:
        text = raw.decode("gb18030", "replace")
    return text.strip("\0 ")


def opened_set(src: Ranged, allow_headerless: bool = True) -> tuple[bool, list[Element], int, bool]:
    """Whether the prefix is there, the file information, where the data set begins, and whether it is explicit. Without
    prefix and file information only implicit little-endian data is taken."""
    if src.get(128, 4) != b"DICM":
        if not allow_headerless:
            raise ValueError("no prefix")
        first = src.get(0, 2)
        if len(first) < 2 or int.from_bytes(first, "little") not in range(0x0008, 0x7FE1):
            raise ValueError("no header")
        return False, [], 0, False
    info = list(elements(src, 132, True, stop=0x00030000, root="file_meta"))
    syntax = next((e.raw for e in info if e.tag == 0x00020010), b"") or b""
    syntax = syntax.decode("ascii", "replace").strip("\0 ")
    if syntax and syntax != IMPLICIT_LE and syntax not in (EXPLICIT_LE, "1.2.840.10008.1.2.5") and not syntax.startswith("1.2.840.10008.1.2.4."):
        raise ValueError(f"transfer syntax {syntax}")
    return True, info, info[-1].at + info[-1].length if info else 132, syntax != IMPLICIT_LE


def parse(data: bytes, allow_headerless: bool = True) -> tuple[bool, list[tuple[str, int, bytes, bytes]]]:
    """Whether the prefix is there, and the elements before the pixels: path, tag, kind, value."""
    src = Ranged(io.BytesIO(data), len(data))
    prefix, _, at, explicit = opened_set(src, allow_headerless)
    found = [(e.path, e.tag, e.vr, e.raw) for e in elements(src, at, explicit, stop=PIXELS) if e.vr != b"SQ" and e.raw is not None]
    if not prefix and (not found or any(tag >> 16 not in range(0x0008, 0x7FE1) for _, tag, _, _ in found[:3])):
        raise ValueError("no header")
    return prefix, found


def opened(path: str):
    """A file by the path that Spark lists it under, for reads by range: local, hdfs, s3 and gs."""
    from pyarrow import fs

    if path.startswith("file:") or "://" not in path:
        return open("/" + path.removeprefix("file:").lstrip("/"), "rb")  # noqa: SIM115
    store, name = fs.FileSystem.from_uri(path)
    return store.open_input_file(name)


SCHEMA = "path string, size long, modified timestamp, prefix boolean, error string, " + ", ".join(f"{k} string" for k in TAGS)


def _rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    keywords = {v: k for k, v in TAGS.items()}
    for pdf in batches:
        out = []
        for path, size, modified, *content in pdf.itertuples(index=False):
            row = {"path": path, "size": size, "modified": modified, "prefix": False, "error": "", **dict.fromkeys(TAGS, "")}
            try:
                with io.BytesIO(content[0]) if content else opened(path) as file:
                    src = Ranged(file, size)
                    row["prefix"], _, at, explicit = opened_set(src)
                    found = [e for e in elements(src, at, explicit, stop=PIXELS) if e.path == "root" and e.vr != b"SQ" and e.raw is not None]
                if not row["prefix"] and not found:
                    raise ValueError("no header")
                for e in found:
                    if e.tag in keywords:
                        row[keywords[e.tag]] = text_of(e.vr, e.raw)
            except (ValueError, OSError, IndexError) as e:
                row["error"] = str(e) or type(e).__name__
            out.append(row)
        yield pd.DataFrame(out)


def candidates(spark: SparkSession, root: str, exclude: str | None, content: bool = False) -> DataFrame:
    """Files below a folder that may be images. Only their listing is dealt out, FILES_PER_TASK to a task, unless Spark reads
    them whole."""
    d = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    d = sources(d, exclude).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"), *(["content"] if content else []))
    if content:
        return d
    return d.repartition(max(1, -(-d.count() // FILES_PER_TASK)), "path")


def read_headers(spark: SparkSession, root: str, exclude: str | None = None, whole: bool = False) -> DataFrame:
    """A row per candidate file below a folder: its listing, the header's TAGS as text, and an error if it has none.
    Tasks read files by range up to the pixels, which are never loaded; ``whole`` lets Spark read them instead, for stores that only
    Spark reaches. Spark lists no empty files."""
    return candidates(spark, root, exclude, whole).mapInPandas(_rows, SCHEMA)


ELEMENTS = (
    "path string, size long, prefix boolean, error string, fetched long, elements array<struct<path:string,tag:string,keyword:string,vr:string,value:string>>, "
    "bulk array<struct<path:string,tag:string,at:long,length:long>>, pixel_sha256 string"
)


def _element_rows(digest: bool):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, size, _ in pdf.itertuples(index=False):  # a row to a batch, as one header may be large
                row = {"path": path, "size": size, "prefix": False, "error": "", "fetched": 0, "elements": [], "bulk": [], "pixel_sha256": ""}
                try:
                    with opened(path) as file:
                        src = Ranged(file, size)
                        row["prefix"], info, at, explicit = opened_set(src)
                        held, bulk, pixels = [], [], None
                        for e in chain(info, elements(src, at, explicit)):
                            if e.raw is None:
                                bulk.append({"path": e.path, "tag": f"{e.tag:08X}", "at": e.at, "length": e.length})
                                pixels = e if e.path == "root" and e.tag == PIXELS else pixels
                            else:
                                value = "" if e.vr == b"SQ" else text_of(e.vr, e.raw)
                                held.append({"path": e.path, "tag": f"{e.tag:08X}", "keyword": KEYWORDS.get(e.tag, ""), "vr": (e.vr or VRS.get(e.tag, b"UN")).decode("ascii", "replace"), "value": value})
                        if not row["prefix"] and not held:
                            raise ValueError("no header")
                        row |= {"elements": held, "bulk": bulk, "fetched": src.fetched}
                        if digest and pixels is not None:
                            row["pixel_sha256"] = sha_of(file, pixels.at, pixels.length)
                except (ValueError, OSError, IndexError) as e:
                    row["error"] = str(e) or type(e).__name__
                yield pd.DataFrame([row])

    return rows


def sha_of(file, at: int, length: int) -> str:
    digest = hashlib.sha256()
    file.seek(at)
    while length and (piece := file.read(min(length, 1 << 20))):
        digest.update(piece)
        length -= len(piece)
    return digest.hexdigest()


def read_elements(spark: SparkSession, root: str, exclude: str | None = None, digest: bool = False) -> DataFrame:
    """A row per candidate file: all its elements, those of nested items as well, depth first, as ``operators.deident`` takes
    them; what is too long to hold, pixels first of all, as places in ``bulk``; ``fetched``: bytes read; an error where the file
    can't be parsed. Elements of the file information have the path ``file_meta``. ``digest`` adds the digest of the pixels, read in
    pieces."""
    return candidates(spark, root, exclude).mapInPandas(_element_rows(digest), ELEMENTS)


def headers(scanned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Scanned files as the ``hdr`` view, and those that are none: with an error, or with too few facts."""
    from studyloom.functions import domain

    c = F.col
    uids = [c("StudyInstanceUID"), c("SeriesInstanceUID"), c("SOPInstanceUID"), c("SOPClassUID")]
    ok = (c("error") == "") & domain.is_header(c("prefix"), uids, [c("PatientID"), c("PatientName"), c("Modality"), c("StudyDate")])
    hdr = scanned.where(ok).select(
        c("path").alias("relative_path"), c("PatientID").alias("patient_id_raw"), c("PatientName").alias("patient_name_raw"), c("PatientBirthDate").alias("birth_date_raw"),
        c("PatientSex").alias("sex_raw"), c("InstitutionName").alias("institution_raw"), c("StudyDate").alias("study_date_raw"), c("AcquisitionDate").alias("acquisition_date_raw"),
        c("StudyInstanceUID").alias("study_uid"), c("SeriesInstanceUID").alias("series_uid"), c("SOPInstanceUID").alias("sop_uid"), c("Modality").alias("modality_raw"),
        c("SeriesDescription").alias("series_description"), c("SliceThickness").alias("slice_thickness_raw"), c("NumberOfFrames").alias("number_of_frames_raw"), c("size").alias("file_size"),
    )
    return hdr, scanned.where(~ok).select("path", F.when(c("error") != "", c("error")).otherwise("not_a_header").alias("reason"))


def scan_counts(scanned: DataFrame, group: str | None = None) -> DataFrame:
    """What a scan has met, over all or by a column: files, images, files that are none, and those of them that a reader failed on."""
    hdr, rejected = headers(scanned)
    d = hdr.select("relative_path", F.lit("image").alias("kind")).union(rejected.select("path", F.when(F.col("reason") == "not_a_header", "other").otherwise("error")))
    if group:
        d = d.join(scanned.select(F.col("path").alias("relative_path"), group), "relative_path").groupBy(group)
    n = lambda k: F.count(F.when(F.col("kind") == k, 1)).alias(f"{k}s")
    return (d if group else d.groupBy()).agg(F.count(F.lit(1)).alias("files"), n("image"), n("other"), n("error"))


def headerless_problems(path: Column, folder: Column, study_uid: Column, series_uid: Column, sop_uid: Column) -> Column:
    """Why a file without prefix may not be taken for the image that it says it is: its place has to be Study/Series/instance.dcm below the
    Study's folder, with the identifiers that it holds. Empty where nothing speaks against it."""
    below = F.regexp_replace(path, F.concat(F.lit("^"), F.regexp_replace(folder, r"([^A-Za-z0-9/])", r"\\$1"), F.lit("/")), "")
    parts, name = F.split(below, "/"), F.substring_index(below, "/", -1)
    inside = path.startswith(F.concat(folder, F.lit("/")))
    why = F.array(
        F.when(F.substring_index(folder, "/", -1) != study_uid, "study_folder"), F.when(F.get(parts, F.lit(0)) != series_uid, "series_folder"),
        F.when(~F.lower(name).endswith(".dcm") | (F.regexp_replace(name, r"\.[^.]*$", "") != sop_uid), "file_name"),
    )
    return F.when(~inside, F.array(F.lit("outside_study"))).when(F.size(parts) != 2, F.array(F.lit("level"))).otherwise(F.array_compact(why))
