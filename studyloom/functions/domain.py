"""Imaging values: modality, sex, instance identifiers' validity, series classification, display names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Series descriptions of three-dimensional reconstructions. Fixed values.
RECON = "(?i)3D|MIP|MPR|VRT?|RECON|VOLUME|DYNACT|CBCT|XPERCT|断层|重建"
TOMOGRAPHY_LABEL, OTHER_LABEL = "（含3D_DSA断层）", "其他/未知"
#: Rank of a modality in displays. Fixed values.
MODALITY_RANK = {"XA": 0, "CT": 1, "MR": 2}
UID_FORM, UID_LENGTH = r"^[0-9]+(\.[0-9]+)+$", 64


def modality(raw: Column) -> Column:
    up = F.upper(F.trim(raw))
    return F.when(up == "MRI", "MR").otherwise(up)


def image_type(values: Column) -> Column:
    """A multi-valued image type in its list form, ['A', 'B']; a value with a single quote only stands in double ones.
    Null is empty, no values are []."""
    slashed = lambda v: F.replace(v, F.lit("\\"), F.lit("\\\\"))
    double = lambda v: v.contains("'") & ~v.contains('"')
    single = lambda v: F.concat(F.lit("'"), F.replace(slashed(v), F.lit("'"), F.lit("\\'")), F.lit("'"))
    quoted = F.transform(values, lambda v: F.when(double(v), F.concat(F.lit('"'), slashed(v), F.lit('"'))).otherwise(single(v)))
    return F.coalesce(F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]")), F.lit(""))


def sex(raw: Column, other: bool = False) -> Column:
    up = F.upper(F.trim(raw))
    return F.when(up.isin("M", "F", *(["O"] if other else [])), up).otherwise("")


def tomography(is_angio: Column, has_thickness: Column, is_recon: Column) -> Column:
    return is_angio & has_thickness & is_recon


def confidence(is_angio: Column, is_3d: Column, known: Column) -> Column:
    """In hundredths, so that it compares exactly."""
    return F.when(is_3d, 82).when(is_angio, 72).when(known, 99).otherwise(60)


def modality_rank(m: Column) -> Column:
    rank = F.lit(99)
    for name, r in MODALITY_RANK.items():
        rank = F.when(m == name, r).otherwise(rank)
    return rank


def ordered_modalities(ms: Column) -> Column:
    """Known ones first in their rank, the others by name."""
    keyed = F.array_sort(F.transform(ms, lambda m: F.struct(modality_rank(m).alias("r"), m.alias("m"))))
    return F.transform(keyed, lambda x: x["m"])


def display_type(ms: Column, has_3d: Column) -> Column:
    shown = F.transform(ordered_modalities(ms), lambda m: F.when((m == "XA") & has_3d, F.concat(m, F.lit(TOMOGRAPHY_LABEL))).otherwise(m))
    return F.when(F.size(ms) == 0, OTHER_LABEL).otherwise(F.array_join(shown, "、"))


def uid_reasons(uid: Column) -> Column:
    """What is wrong with an identifier, as a list: empty if it conforms."""
    return F.array_compact(
        F.array(
            F.when(uid == "", "missing"),
            F.when((uid != "") & ~uid.rlike(UID_FORM), "format"),
            F.when(F.length(uid) > UID_LENGTH, "length"),
            F.when(uid.rlike(r"(^|\.)0[0-9]"), "leading_zero"),
        )
    )


def path_unsafe(component: Column) -> Column:
    """Whether a value can't be a path component as it is."""
    return component.rlike(r'[<>:"/\\|?*\x00-\x1f]') | component.isin("", ".", "..") | (F.length(component) > 240) | component.rlike("[. ]$")


def is_header(prefix: Column, uids: list[Column], facts: list[Column], uids_needed: int = 1, facts_needed: int = 3) -> Column:
    """Whether a file is an imaging header: its prefix, identifiers or enough other facts say so."""
    n = lambda cs: sum((F.when(c != "", 1).otherwise(0) for c in cs), F.lit(0))
    return prefix | (n(uids) >= uids_needed) | (n(facts) >= facts_needed)


#: Display names of storage classes. Fixed values.
SOP_CLASSES = {
    "1.2.840.10008.5.1.4.1.1.2": "CT", "1.2.840.10008.5.1.4.1.1.4": "MR", "1.2.840.10008.5.1.4.1.1.7": "SC", "1.2.840.10008.5.1.4.1.1.12.1": "XA",
    "1.2.840.10008.5.1.4.1.1.12.1.1": "Enhanced XA", "1.2.840.10008.5.1.4.1.1.13.1.1": "X-Ray 3D Angiographic",
}


def sop_class_name(uid: Column) -> Column:
    out = uid
    for key, name in SOP_CLASSES.items():
        out = F.when(uid == key, name).otherwise(out)
    return out


def suffix_conflicts(sex_: Column, suffix_sex: Column, years: Column, suffix_years: Column) -> Column:
    """Where a name's suffix contradicts the header: another sex, an age more than a year apart."""
    return F.array_compact(
        F.array(
            F.when((sex_ != "") & (suffix_sex != "") & (sex_ != suffix_sex), "suffix_sex"),
            F.when(F.abs(years - suffix_years) > 1, "suffix_age"),
        )
    )


def screening_in_center(screening: Column, center_code: Column) -> Column:
    """Whether a screening number begins with its center's code."""
    return (center_code != "") & screening.startswith(F.concat(center_code, F.lit("-")))
