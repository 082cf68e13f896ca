"""De-identification of nested header data, flattened to ``elements``: array<struct<path, tag, keyword, vr, value>>.

An element of a nested item has its sequence's place in its path, so one pass over the array is the recursive walk.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studyloom.functions import dates, text
from studyloom.functions.local import once

ELEMENT = "struct<path:string,tag:string,keyword:string,vr:string,value:string>"
#: Keywords that always go where identity is removed. Fixed values.
REMOVED = ("PatientName", "PatientBirthDate", "InstitutionName")
TEXT_VRS = ("LO", "LT", "PN", "SH", "ST", "UC", "UT")
DATE_VRS = ("DA", "DT")

#: Where a code stands for the name: tags that go besides the caller's list, that are emptied, times whose fractions go, and those that
#: stay whatever a list says. Fixed values.
EXTRA_DELETED = ("00182042", "00620021", "20300020", "70051063", "70051067", "70051068", "70051069", "7005106C", "7005106D")
CLEARED = ("00080081", "00081040")
TIMES = ("00080030", "00080031", "00080032", "00080033")
KEPT = ("00100020", "00080080", "00080060")

#: Where identity is replaced: keywords that are emptied, sequences that go with all they hold, keywords that go, that stay, and
#: identifiers that are not remapped. Fixed values.
EMPTIED = (
    "PatientBirthDate", "PatientBirthTime", "PatientSex", "PatientAge", "PatientSize", "PatientWeight", "PatientAddress", "PatientTelephoneNumbers",
    "PatientMotherBirthName", "MilitaryRank", "BranchOfService", "MedicalRecordLocator", "OtherPatientIDs", "OtherPatientNames", "EthnicGroup",
    "Occupation", "AdditionalPatientHistory", "PatientComments", "AdmissionID", "IssuerOfAdmissionID", "AccessionNumber", "StudyID",
    "InstitutionAddress", "InstitutionalDepartmentName", "ReferringPhysicianName", "ReferringPhysicianAddress", "ReferringPhysicianTelephoneNumbers",
    "PerformingPhysicianName", "NameOfPhysiciansReadingStudy", "OperatorsName", "PhysicianOfRecord", "DeviceSerialNumber", "StationName",
    "ProtocolName", "StudyDescription", "SeriesDescription", "ContentDescription", "AcquisitionComments", "ReasonForStudy", "DerivationDescription",
    "RequestingPhysician", "RequestingService", "RequestedProcedureDescription", "ScheduledPerformingPhysicianName",
    "ScheduledProcedureStepDescription", "PerformedProcedureStepDescription", "ContentCreatorName", "ImageComments", "StudyComments",
    "IssuerOfPatientID",
)
EMPTIED_SEQUENCES = ("00101002", "00080082", "00081049")
DELETED = ("TargetUID", "TrackingUID", "TextString")
PRESERVED = ("PatientID", "InstitutionName")
NOT_REMAPPED = ("SOPClassUID", "ReferencedSOPClassUID", "TransferSyntaxUID", "ImplementationClassUID", "CodingSchemeUID", "ContextGroupExtensionCreatorUID")
METHOD = "Name replaced; PatientID retained; private removed; UID/date map"


def tag_list(text: str) -> list[str]:
    """Tags of a text that lists them as ``(gggg,eeee)``, in the form that elements have."""
    return [f"{g}{e}".upper() for g, e in re.findall(r"\(([0-9A-Fa-f]{4}),\s*([0-9A-Fa-f]{4})\)", text)]


def named(e: Column, aliases: list[str]) -> Column:
    """Whether a text element names a center; aliases of one letter name none."""
    return e["vr"].isin(*TEXT_VRS) & text_contains(e["value"], [a for a in aliases if len(a) > 1])


def remove_identity(elements: Column, aliases: list[str]) -> tuple[Column, Column]:
    """The elements without REMOVED ones and without texts that name a center (PatientID stays), and a struct of how
    many went for which reason and where a center's name was retained."""
    why = F.transform(
        elements,
        lambda e: F.when(e["keyword"].isin(*REMOVED), e["keyword"])
        .when(named(e, aliases), F.when(e["keyword"] == "PatientID", F.concat(F.lit("@"), e["path"], F.lit("/"), e["tag"])).otherwise("aliases"))
        .otherwise(""),
    )
    gone = (*REMOVED, "aliases")
    kept = F.filter(elements, lambda e: ~e["keyword"].isin(*REMOVED) & ((e["keyword"] == "PatientID") | ~named(e, aliases)))
    retained = F.transform(F.filter(why, lambda x: x.startswith("@")), lambda x: F.substring(x, 2, 1 << 20))
    start = F.struct(*[F.lit(0).alias(k) for k in gone])
    # counted in one fold over the reasons instead of a walk for each
    counts = F.aggregate(why, start, lambda acc, x: F.struct(*[(acc[k] + F.when(x == k, 1).otherwise(0)).alias(k) for k in gone]))
    return kept, F.struct(*[counts[k].alias(k) for k in gone], retained.alias("retained"))


def without_identity(df: DataFrame, column: str, aliases: list[str], kept: str = "kept", counts: str = "counts") -> DataFrame:
    """df with what ``remove_identity`` leaves of a column and what it tells. The reasons are a projection of their own."""
    left, told = remove_identity(F.col(column), aliases)
    return df.select("*", left.alias(kept), told.alias(counts))


def private(tag: Column) -> Column:
    """Whether a tag's group number is odd."""
    return F.substring(tag, 4, 1).isin(*"13579bdfBDF")


def inside(e: Column, tags: list[str] | tuple[str, ...]) -> Column:
    """Whether an element stands in a sequence with one of these tags, however deep."""
    around = F.regexp_extract_all(e["path"], F.lit("/([0-9A-Fa-f]{8})"), F.lit(1))
    return F.exists(around, lambda x: F.upper(x).isin(*tags))


def text_contains(value: Column, words: list[str]) -> Column:
    low, out = F.lower(value), F.lit(False)
    for w in words:
        out = out | low.contains(w.lower())
    return out


def _with_value(e: Column, value: Column) -> Column:
    return F.struct(e["path"].alias("path"), e["tag"].alias("tag"), e["keyword"].alias("keyword"), e["vr"].alias("vr"), value.alias("value"))


def by_code(elements: Column, code: Column, deleted: list[str]) -> Column:
    """A code stands for the name on every level; tags of ``deleted`` and EXTRA_DELETED go, sequences with all they hold; CLEARED values
    are emptied, TIMES lose fractions. KEPT tags stay whatever the list says, if no sequence that goes holds them."""
    gone = tuple(dict.fromkeys((*(t.upper() for t in deleted), *EXTRA_DELETED)))
    going = [t for t in gone if t not in KEPT]
    tag = lambda e: F.upper(e["tag"])
    kept = F.filter(elements, lambda e: ~tag(e).isin(*going) & ~inside(e, going))
    value = lambda e: (
        F.when(tag(e) == "00100010", code).when(tag(e).isin(*CLEARED), "").when(tag(e).isin(*TIMES), dates.without_fraction(e["value"])).otherwise(e["value"])
    )
    return F.transform(kept, lambda e: _with_value(e, value(e)))


def remapped_keyword(keyword: Column) -> Column:
    """Whether identifiers of this keyword name an instance, and so get a new value."""
    ends = keyword.endswith("InstanceUID") | keyword.endswith("FrameOfReferenceUID") | keyword.isin("DimensionOrganizationUID", "TrackingUID")
    return ends & ~keyword.isin(*NOT_REMAPPED)


#: Elements of the root by which a file tells that identity was replaced. Fixed values.
TOLD = (("00120062", "PatientIdentityRemoved", "CS", "YES"), ("00120063", "DeidentificationMethod", "LO", METHOD))


#: Where a path leads through an emptied sequence or a private one. A pattern, because a constant path is then judged when the plan is made.
_INSIDE_GONE = f"(?i)/(?:{'|'.join(EMPTIED_SEQUENCES)}|[0-9a-f]{{3}}[13579bdf][0-9a-f]{{4}})"


def _stays(e: Column) -> Column:
    return ~private(e["tag"]) & ~F.upper(e["tag"]).isin(*EMPTIED_SEQUENCES) & ~(e["keyword"].isin(*DELETED)) & ~e["path"].rlike(_INSIDE_GONE) & ~((e["path"] == "root") & e["tag"].isin(*[t[0] for t in TOLD]))


def _replaced(e: Column, days: Column, salt: str, originals: Column, code: Column, generated: bool) -> Column:
    """An element that stays, with its new value."""
    uid = lambda u: dates.remap_uid(u, salt, generated)
    each = lambda v: F.array_join(F.transform(F.split(v, r"\\"), lambda u: dates.remap_uid(u, salt)), "\\")
    uids = lambda v: F.coalesce(uid(F.when(~v.contains("\\"), v)), each(v))
    value = (
        F.when(e["keyword"].isin(*PRESERVED), e["value"]).when(e["keyword"].isin(*EMPTIED), "").when(e["keyword"] == "PatientName", code)
        .when((e["vr"] == "UI") & (remapped_keyword(e["keyword"]) | (e["tag"] == "00020003")), uids(e["value"]))
        .when(e["vr"].isin(*DATE_VRS), dates.shifted_time(e["value"], days)).when(e["vr"].isin(*TEXT_VRS), _scrubber(originals, code)(e["value"])).otherwise(e["value"])
    )
    return _with_value(e, value)


def _root(tag: str, keyword: str, vr: str, value: Column) -> Column:
    return F.struct(F.lit("root").alias("path"), F.lit(tag).alias("tag"), F.lit(keyword).alias("keyword"), F.lit(vr).alias("vr"), value.alias("value"))


def _root_name(e: Column) -> Column:
    return (e["path"] == "root") & (e["keyword"] == "PatientName")


def replace_identity(elements: Column, subject: Column, salt: str, originals: Column, code: Column) -> Column:
    """Everything that tells who someone is goes or is replaced, on every level: private tags and DELETED ones go, sequences with all
    they hold; EMPTIED values are emptied; the name becomes the code; identifiers of instances, dates and texts are replaced,
    each the same way wherever it stands. The root tells so, and the file information names the new instance."""
    # what stays and the days are found once for a row, not for each element and each mention
    held = F.struct(F.filter(elements, _stays).alias("kept"), dates.shift_days(subject, salt).alias("days"))
    name = F.array(_root("00100010", "PatientName", "PN", code))
    marks = F.array(*[_root(*t[:3], F.lit(t[3])) for t in TOLD])
    return once(
        held,
        lambda h: F.concat(
            F.transform(h["kept"], lambda e: _replaced(e, h["days"], salt, originals, code, False)), F.when(F.exists(h["kept"], _root_name), F.array().cast(f"array<{ELEMENT}>")).otherwise(name), marks
        ),
    )


def replace_identity_of(elements: list[Column], subject: Column, salt: str, originals: Column, code: Column) -> list[Column]:
    """As ``replace_identity``, for elements that are columns instead of one array: null in place of what goes. Outside lambdas all of it is
    generated code, and what depends on a constant tag is decided when the plan is made."""
    days = dates.shift_days(subject, salt, True)
    out = [F.when(_stays(e), _replaced(e, days, salt, originals, code, True)) for e in elements]
    named_ = reduce(lambda x, y: x | y, [F.coalesce(_stays(e) & _root_name(e), F.lit(False)) for e in elements], F.lit(False))
    return [*out, F.when(~named_, _root("00100010", "PatientName", "PN", code)), *[_root(*t[:3], F.lit(t[3])) for t in TOLD]]


def _scrubber(originals: Column, code: Column) -> Callable[[Column], Column]:
    """Puts the code for every original text, whatever its case, longer ones first."""
    longest = F.array_sort(originals, lambda x, y: F.coalesce(F.length(y), F.lit(0)) - F.coalesce(F.length(x), F.lit(0)))
    quoted = lambda x: F.concat(F.lit("(?iu)"), F.regexp_replace(x, r"([^\p{L}\p{N}\s])", r"\\$1"))
    plain = F.regexp_replace(code, r"([\\$])", r"\\$1")
    return lambda v: F.aggregate(longest, v, lambda acc, x: F.when(F.coalesce(x, F.lit("")) == "", acc).otherwise(F.regexp_replace(acc, quoted(x), plain)))


def shift_and_scrub(elements: Column, subject: Column, salt: str, originals: Column, code: Column) -> Column:
    """Dates move by the subject's own shift; every original text of the identity, whatever its case, becomes the code,
    longer ones first."""
    days, scrub = dates.shift_days(subject, salt), _scrubber(originals, code)
    value = lambda e: F.when(e["vr"].isin(*DATE_VRS), dates.shifted_time(e["value"], days)).when(e["vr"].isin(*TEXT_VRS), scrub(e["value"])).otherwise(e["value"])
    return F.transform(elements, lambda e: _with_value(e, value(e)))


def snapshot(elements: Column) -> Column:
    """What must not change, in its order: the patient id, dates and times but for the birth date, and all identifiers."""
    held = lambda e: (e["keyword"] == "PatientID") | (e["vr"].isin("DA", "DT", "TM") & (e["keyword"] != "PatientBirthDate")) | (e["vr"] == "UI")
    return F.transform(F.filter(elements, held), lambda e: F.struct(e["path"], e["tag"], e["value"]))


def verify(df: DataFrame, before: str, after: str, aliases: list[str], pixels: tuple[str, str] | None = None) -> DataFrame:
    """df with ``problems``: protected values that changed, identity left behind, a center still named, and with the columns of
    two digests, pixels that changed."""
    left = F.exists(after, lambda e: e["keyword"].isin(*REMOVED))
    center = F.exists(after, lambda e: (e["keyword"] != "PatientID") & named(e, aliases))
    why = [F.when(snapshot(F.col(before)) != snapshot(F.col(after)), "changed"), F.when(left, "identity_left"), F.when(center, "center_named")]
    if pixels:
        why.append(F.when(~F.col(pixels[0]).eqNullSafe(F.col(pixels[1])), "pixels_changed"))
    return df.withColumn("problems", F.array_join(F.array_compact(F.array(*why)), ","))


def remap_uids(df: DataFrame, columns: list[str], salt: str) -> DataFrame:
    """Identifiers replaced by their own hash's, each distinct one computed once."""
    for c in columns:
        new = df.select(c).where(F.col(c) != "").distinct().withColumn("_new", dates.remap_uid(F.col(c), salt))
        df = df.join(new, c, "left").withColumn(c, F.coalesce("_new", F.col(c))).drop("_new")
    return df


def scrubbed_csv(df: DataFrame) -> DataFrame:
    """Text columns made safe for spreadsheets."""
    return df.withColumns({c: text.csv_guard(F.col(c)) for c, kind in df.dtypes if kind == "string"})
