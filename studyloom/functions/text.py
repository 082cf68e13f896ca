"""Normalisers of identifiers, names and other text. Missing text is the empty string, as in all header data.

Every function maps a Column to a Column and stays in generated code; ``nfkc`` and ``pinyin_initials`` are the
exceptions, for which Spark has no built-in.
"""

from __future__ import annotations

import unicodedata
from bisect import bisect_right

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Separator of joined lists in reports, and the split pattern that reads them back. Fixed values.
JOINER, JOINED = "、", "[、|]"
#: Names that stand for no name. Fixed values.
PLACEHOLDERS = ("anonymized", "anonymous", "noname", "patient", "test", "unknown", "无名氏", "未知", "匿名")
#: Words of folder names that are no person's name. Fixed values.
GENERIC_WORDS = ("影像", "术前", "术后", "术中", "患者", "资料", "数据", "检查")
#: Placeholders of an absent instance identifier. Fixed values.
SOP_SENTINELS = ("/", "N/A", "NA", "NONE", "NULL")
YES = ("1", "true", "y", "yes", "是", "√")
WINDOWS_DEVICES = r"(?i)^(con|prn|aux|nul|com[1-9]|lpt[1-9])(\..*)?$"

_FULL_WIDTH = "".join(chr(0xFEE0 + c) for c in range(0x21, 0x7F)) + "　"
_ASCII = "".join(map(chr, range(0x21, 0x7F))) + " "


# First GB 2312 codes of the level-1 characters by pinyin initial, and the code after the last. Fixed values.
INITIAL_STARTS = (
    ("A", 45217), ("B", 45253), ("C", 45761), ("D", 46318), ("E", 46826), ("F", 47010), ("G", 47297), ("H", 47614), ("J", 48119), ("K", 49062), ("L", 49324), ("M", 49896),
    ("N", 50371), ("O", 50614), ("P", 50622), ("Q", 50906), ("R", 51387), ("S", 51446), ("T", 52218), ("W", 52698), ("X", 52980), ("Y", 53689), ("Z", 54481), ("", 55290),
)


@F.pandas_udf(T.StringType())
def pinyin_initials(text: pd.Series) -> pd.Series:
    """Pinyin initials of the common Chinese characters, which their standard code is ordered by. A name with another
    Chinese character has none at all, for the rest would match other people's; what is not Chinese is passed over."""
    starts = [s for _, s in INITIAL_STARTS]

    def one(c: str) -> str:
        code = c.encode("gb2312", "ignore")
        k = bisect_right(starts, int.from_bytes(code, "big")) - 1 if len(code) == 2 else -1
        return INITIAL_STARTS[k][0] if k >= 0 else ""

    def whole(name: str | None) -> str:
        found = [one(c) for c in name or "" if "\u3400" <= c <= "\u9fff"]
        return "".join(found) if all(found) else ""

    return text.map(whole)


@F.pandas_udf(T.StringType())
def nfkc(text: pd.Series) -> pd.Series:
    """Full compatibility normalisation, for text beyond full-width forms."""
    return text.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


def half_width(text: Column) -> Column:
    """Full-width ASCII forms and the wide blank as ASCII: the part of NFKC that header text needs."""
    return F.translate(text, _FULL_WIDTH, _ASCII)


def clean(text: Column) -> Column:
    return F.coalesce(F.trim(text), F.lit(""))


def number_text(value: Column) -> Column:
    """A number as a table cell shows it: whole numbers without a fraction, none for NaN or null."""
    whole = (F.floor(value) == value) & (F.abs(value) < 1e15)
    shown = F.when(whole, value.cast("long").cast("string")).otherwise(value.cast("string"))
    return F.when(value.isNull() | F.isnan(value), "").otherwise(shown)


def patient_id(raw: Column) -> Column:
    """Without a device suffix ``!UUID``; a partial one stays."""
    uuid = "[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
    return F.regexp_replace(clean(raw), f"(?i)^(.+?)!{uuid}$", "$1")


_SUFFIX = r"(?i)^(.*?)[ ,_-]+(?:([MF])[ -]*([0-9]{1,3})Y|([0-9]{1,3})Y[ -]*([MF]))$"


def spaced_name(raw: Column) -> Column:
    """A person name with component marks and runs of blanks as single blanks, and no edge punctuation."""
    flat = F.trim(F.regexp_replace(half_width(clean(raw)), r"[\^\s]+", " "))
    return F.trim(F.regexp_replace(flat, r"^[ ,;._-]+|[ ,;._-]+$", ""))


def name_parts(raw: Column) -> Column:
    """What ``named`` reads: a name, then the four places of a suffix where there is one. One pattern runs, once."""
    return F.split(F.regexp_replace(spaced_name(raw), _SUFFIX, "$1\x01$2\x01$3\x01$4\x01$5"), "\x01")


def named(parts: Column) -> Column:
    """struct<name, sex, age> of ``name_parts``. Where many columns come of it, make the parts a column of their own first,
    so that they are found once."""
    held = F.size(parts) == 5
    either = lambda i, j: F.concat(parts[i], parts[j])
    return F.struct(
        F.when(held, F.trim(parts[0])).otherwise(parts[0]).alias("name"),
        F.when(held, F.upper(either(1, 4))).otherwise("").alias("sex"),
        F.when(held, F.concat(F.lpad(either(2, 3), 3, "0"), F.lit("Y"))).otherwise("").alias("age"),
    )


def parse_name(raw: Column) -> Column:
    """struct<name, sex, age>: a trailing ``M-56Y`` or ``56Y M`` is split off, the age as three digits and Y."""
    return F.transform(F.array(name_parts(raw)), named)[0]


def name_key(name: Column) -> Column:
    """Letters and digits in lower case; empty for a placeholder name."""
    return no_placeholder(letters(name))


def letters(name: Column) -> Column:
    """Letters and digits in lower case."""
    return F.regexp_replace(F.lower(half_width(clean(name))), r"[^\p{L}\p{N}]", "")


def no_placeholder(key: Column) -> Column:
    return F.when(key.isin(*PLACEHOLDERS), "").otherwise(key)


def bare_name(name: Column) -> Column:
    """The looser key of registry tables: blanks and component marks go, all else stays."""
    return F.lower(F.regexp_replace(half_width(clean(name)), r"[\s^]+", ""))


def identifier_key(value: Column, keep_case: bool = False) -> Column:
    """``123.0`` is ``123``; blanks go."""
    key = F.regexp_replace(F.regexp_replace(clean(value), r"\s+", ""), r"^([+-]?[0-9]+)\.0+$", "$1")
    return key if keep_case else F.lower(key)


def center_key(value: Column) -> Column:
    return F.lower(F.regexp_replace(half_width(clean(value)), r"[\s_()\-]+", ""))


def header_key(value: Column) -> Column:
    """The key by which a table's header cells are recognised."""
    return F.lower(F.regexp_replace(half_width(clean(value)), r"[\s_/()\-]+", ""))


def screening_number(value: Column) -> Column:
    """``15_H001`` as ``15-H001``; anything else than digits, a mark and H or Q with digits is none."""
    form = r"(?i)^([0-9]+)[_-]([HQ][0-9]+)$"
    flat = half_width(clean(value))
    return F.when(flat.rlike(form), F.upper(F.concat_ws("-", F.regexp_extract(flat, form, 1), F.regexp_extract(flat, form, 2)))).otherwise("")


def short_screening(value: Column) -> Column:
    """The ledger's form: no leading zeros of the center number."""
    return F.regexp_replace(screening_number(value), "^0+(?=[0-9])", "")


def institution_key(value: Column, synonyms: dict[str, tuple[str, ...]] | None = None) -> Column:
    """Letters and digits in lower case; one that holds all words of a synonym is that synonym's key."""
    key = F.regexp_replace(F.lower(half_width(clean(value))), r"[^\p{L}\p{N}]", "")
    out = key
    for name, words in (synonyms or {}).items():
        held = F.lit(True)
        for w in words:
            held = held & key.contains(w)
        out = F.when(held, name).otherwise(out)
    return out


def cjk_name(value: Column) -> Column:
    """The first run of Chinese characters, unless it is a generic word."""
    run = F.regexp_extract(clean(value), r"([\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}]+)", 1)
    return F.when(run.isin(*GENERIC_WORDS), "").otherwise(run)


def path_name(path: Column, patient: Column, root: Column | None = None, header: Column | None = None) -> Column:
    """The best Chinese name among a path's components: early ones, ones with the patient's id (whatever its case) and names of two to
    six characters score more; the first of equals wins. The source folder's own name, ``root``, is a candidate too, the last one, and
    worth more than a component without the id. Where no candidate is, the header's name without carets."""
    return _best_name(path, patient, root, 80, 200, False, header)


def owned_name(path: Column, patient: Column, root: Column | None = None) -> Column:
    """As ``path_name``, but only of components that hold the patient's id: the name that a folder gives to this id."""
    return _best_name(path, patient, root, 100, 200, True, None)


def _best_name(path: Column, patient: Column, root: Column | None, first: int, owned: int, needed: bool, header: Column | None) -> Column:
    ident = F.lower(F.trim(patient))
    holds = lambda x: (ident != "") & F.lower(x).contains(ident)

    def candidate(x: Column, score: Column, at: Column) -> Column:
        name = cjk_name(x)
        score = score + F.when(holds(x), owned).otherwise(0) + F.when(F.length(name).between(2, 6), 20).otherwise(0)
        return F.struct(score.alias("score"), at.alias("at"), name.alias("name"), holds(x).alias("held"))

    scored = F.transform(F.split(path, "/"), lambda x, i: candidate(x, F.lit(first) - F.least(i, F.lit(40)), -i))
    if root is not None:
        scored = F.concat(scored, F.array(candidate(root, F.lit(110 if needed else 100), F.lit(-(1 << 20)))))
    good = F.filter(scored, lambda s: (s["name"] != "") & (s["held"] if needed else F.lit(True)))
    last = F.trim(F.replace(header, F.lit("^"), F.lit(" "))) if header is not None else F.lit("")
    return F.coalesce(F.array_max(good)["name"], last, F.lit(""))


def initials_match(name: Column, initials: Column) -> Column:
    """Whether Latin text begins with the first initial and has the others in order; two initials at least."""
    letters = F.regexp_replace(F.upper(name), "[^A-Z]", "")
    pattern = F.concat(F.lit("^"), F.array_join(F.split(F.upper(initials), ""), "[A-Z]*"))
    return (F.length(initials) >= 2) & F.rlike(letters, pattern)


def chinese_matches_header(name: Column, header: Column) -> Column:
    """Whether a Chinese name's initials fit a Latin header name."""
    return initials_match(header, pinyin_initials(name))


def match_key(hospital_number: Column, name: Column) -> Column:
    """The key by which a folder named after an id and a name is found."""
    return F.lower(F.regexp_replace(F.concat(clean(hospital_number), clean(name)), r"[\s_\-^.,]+", ""))


def path_component(value: Column, fallback: str = "UNKNOWN") -> Column:
    """A safe file or folder name: forbidden characters as ``_``, no trailing dot or blank, 180 characters."""
    safe = F.regexp_replace(F.regexp_replace(clean(value), r'[<>:"/\\|?*\x00-\x1f]', "_"), r"[. ]+$", "")
    safe = F.when(safe.rlike(WINDOWS_DEVICES), F.concat(F.lit("_"), safe)).otherwise(safe)
    return F.when(safe == "", fallback).otherwise(F.substring(safe, 1, 180))


def path_hash(path: Column) -> Column:
    return F.sha2(F.replace(path, F.lit("\\"), F.lit("/")).cast("binary"), 256)


def sop_text(value: Column) -> Column:
    """An instance identifier; the placeholders of an absent one are empty."""
    flat = clean(value)
    return F.when(F.upper(flat).isin(*SOP_SENTINELS), "").otherwise(flat)


def code_text(number: Column) -> Column:
    """A positive number in three digits or more; else null."""
    shown = number.cast("string")
    return F.when(number > 0, F.when(F.length(shown) < 3, F.lpad(shown, 3, "0")).otherwise(shown))


def is_yes(value: Column) -> Column:
    return F.lower(clean(value)).isin(*YES)


def natural_key(value: Column) -> Column:
    """A text that sorts with its runs of digits as numbers: each run gets its length before it."""
    runs = F.regexp_extract_all(clean(value), F.lit("([0-9]+|[^0-9]+)"), 1)
    number = lambda x: F.regexp_replace(x, "^0+(?=[0-9])", "")
    keyed = F.transform(runs, lambda x: F.when(x.rlike("^[0-9]"), F.concat(F.lpad(F.length(number(x)).cast("string"), 3, "0"), number(x))).otherwise(F.lower(x)))
    return F.array_join(keyed, "")


#: Words for kinds of imaging where a source name has no token of one, in their order. Fixed values.
TYPE_WORDS = (("灌注", "CTP"), ("血管", "CTA"), ("数字减影", "DSA"), ("减影血管", "DSA"), ("平扫", "CT"))


def image_type(name: Column) -> Column:
    """Kinds of imaging that a source name tells, in order and once each, joined by ``+``; else those that its words mean, in the order of
    TYPE_WORDS; ``REVIEW`` if none."""
    plain = F.upper(half_width(clean(name)))
    found = F.regexp_extract_all(plain, F.lit("(NCCT|CTTP|CTP|CTA|DSA|CT)"), 1)
    kinds = F.array_distinct(F.transform(found, lambda x: F.when(x == "NCCT", "CT").when(x == "CTTP", "CTP").otherwise(x)))
    words = F.array_distinct(F.array_compact(F.array(*[F.when(plain.contains(w), kind) for w, kind in TYPE_WORDS])))
    return F.when(F.size(kinds) > 0, F.array_join(kinds, "+")).when(F.size(words) > 0, F.array_join(words, "+")).otherwise("REVIEW")


def merge_joined(*texts: Column) -> Column:
    """Joined lists as one: split, distinct, sorted, joined again."""
    parts = F.transform(F.split(F.concat_ws(JOINER, *texts), JOINED), lambda x: F.trim(x))
    return F.array_join(F.array_sort(F.array_distinct(F.filter(parts, lambda x: x != ""))), JOINER)


def first_seen_join(values: Column, order: Column, joiner: str = JOINER) -> Column:
    """An aggregate: distinct values that are not empty, in the order in which they are first seen."""
    rows = F.array_sort(F.collect_set(F.when(values != "", F.struct(order.alias("o"), values.alias("v")))))
    return F.array_join(F.array_distinct(F.transform(rows, lambda x: x["v"])), joiner)


def replace_identity(value: Column, originals: list[str], code: Column) -> Column:
    """Every original, whatever its case, replaced by the code; longer ones first."""
    out = value
    for x in sorted((x for x in originals if x), key=len, reverse=True):
        out = F.regexp_replace(out, F.lit(r"(?i)\Q" + x.replace(r"\E", r"\E\\E\Q") + r"\E"), code)
    return out


def csv_guard(text: Column) -> Column:
    """Text that a spreadsheet would read as a formula gets a quote before it."""
    return F.when(F.ltrim(text).rlike(r"^[=+\-@]"), F.concat(F.lit("'"), text)).otherwise(text)
