"""Dates, ages, visit periods, and the date shift and identifier remap of de-identification."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from studyloom.functions.local import once

#: Days of a month in a visit period; days that a shift may reach. Fixed values.
MONTH_DAYS, SHIFT_DAYS = 30, 3651
#: Names of the periods before and at surgery. Fixed values.
BEFORE, DURING = "术前", "术中"
#: Nine decimal digits, and those of 2^96, 2^64, 2^32 and 1 in nines, the last first.
NINES = 10**9
POWERS = tuple(tuple(x // NINES**k % NINES for k in range(4)) for x in (1 << 96, 1 << 64, 1 << 32, 1))


def valid_date(raw: Column) -> Column:
    """The date in the first eight digits; null if they are none."""
    return F.try_to_date(F.substring(F.regexp_replace(F.coalesce(raw, F.lit("")), "[^0-9]", ""), 1, 8), "yyyyMMdd")


def first_date(*raw: Column) -> Column:
    return F.coalesce(*[valid_date(r) for r in raw])


def table_date(value: Column) -> Column:
    """A date cell: a serial number, or a date in one of the usual forms."""
    text = F.trim(value)
    serial = F.floor(text.try_cast("double")).cast("int")
    days = F.when(text.rlike(r"^[0-9]{1,6}(\.[0-9]+)?$"), F.date_add(F.lit("1899-12-30").cast("date"), serial))
    return F.coalesce(days, *[F.try_to_date(text, f) for f in ("yyyy-M-d", "yyyy/M/d", "yyyy.M.d", "yyyyMMdd")])


def date_token(text: Column) -> Column:
    """The first plausible date in a text."""
    return valid_date(F.regexp_extract(text, r"(?<![0-9])((?:19|20)[0-9]{2}[-_.]?[0-9]{2}[-_.]?[0-9]{2})(?![0-9])", 1))


def period(imaging: Column, surgery: Column) -> Column:
    """Before, at, or after surgery: after it the months as text, days over 30 in two decimals."""
    days = F.datediff(imaging, surgery)
    months = F.round(days / F.lit(float(MONTH_DAYS)), 2)
    return F.when(days < 0, BEFORE).when(days == 0, DURING).when(days > 0, F.format_string("%.2f", months))


def period_months(text: Column) -> Column:
    """Months of a period text: a bare number or ``术后N个月``."""
    return F.coalesce(F.trim(text).try_cast("double"), F.regexp_extract(text, "术后 *([0-9.]+) *个月", 1).try_cast("double"))


def age_years(age: Column) -> Column:
    """Years of an age such as ``056Y``, ``006M``, ``010W`` or ``003D``; null for anything else."""
    form = "^([0-9]{1,3})([DWMY])$"
    n = F.regexp_extract(F.upper(F.trim(age)), form, 1).try_cast("double")
    unit = F.regexp_extract(F.upper(F.trim(age)), form, 2)
    return F.when(unit == "Y", n).when(unit == "M", n / 12).when(unit == "W", n / 52.18).when(unit == "D", n / 365.25)


def age_text(raw: Column) -> Column:
    """An age in the form that ``age_years`` reads, or the empty string."""
    up = F.upper(F.trim(raw))
    return F.when(up.rlike("^[0-9]{1,3}[DWMY]$"), up).otherwise("")


def birth_year(age: Column, study: Column) -> Column:
    return F.year(study) - age_years(age)


def compact_date(d: Column) -> Column:
    return F.date_format(d, "yyyyMMdd").cast("int")


def shift_days(subject: Column, salt: str, generated: bool = False) -> Column:
    """A subject's own shift, the same in every run: a hash modulo SHIFT_DAYS, forward if the hash is odd."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{salt}|DATE|"), subject).cast("binary"), 256), 1, 8), 16, 10).cast("long")
    days = lambda x: (x % SHIFT_DAYS).cast("int")
    return once(h, lambda x: F.when(x % 2 == 1, days(x)).otherwise(-days(x)), generated)


def shifted(raw: Column, days: Column) -> Column:
    """A date value moved by days, as yyyyMMdd; a value that is no date stays."""
    return F.coalesce(F.date_format(F.date_add(valid_date(raw), days), "yyyyMMdd"), raw)


def shifted_time(raw: Column, days: Column) -> Column:
    """As ``shifted``; digits of a time of day behind the date stay with it."""
    return F.when(raw.rlike("^[0-9]{9}"), F.concat(shifted(F.left(raw, F.lit(8)), days), F.substring(raw, 9, 64))).otherwise(shifted(raw, days))


def decimal_text(digits: Column, generated: bool = False) -> Column:
    """The first 32 hexadecimal digits as a decimal number. Its 39 digits are beyond Spark's decimals, so they come in nines, the last
    first: each limb times the nines of its power in POWERS, which stays below 2^63 in sum, and what the nine before carries."""
    limbs = [F.conv(F.substring(digits, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]
    nine = F.lit(NINES)

    def text(limb: Column | list[Column]) -> Column:
        # the sums so far, and the last one
        def further(k: int, low: list[Column]) -> Column:
            parts = [limb[i] if p[k] == 1 else limb[i] * F.lit(p[k]) for i, p in enumerate(POWERS) if p[k]]
            here = reduce(lambda x, y: x + y, parts + [F.call_function("div", x, nine) for x in low[-1:]])
            return once(here, lambda x: further(k + 1, [*low, x]), generated) if k < 3 else shown(here, *low)

        def shown(top: Column, first: Column, second: Column, third: Column) -> Column:
            middle = third % nine * nine + second % nine
            padded = F.concat(top.cast("string"), F.lpad(middle.cast("string"), 18, "0"), F.lpad((first % nine).cast("string"), 9, "0"))
            return F.regexp_replace(padded, "^0+(?=[0-9])", "")

        return further(0, [])

    return once(limbs, text, generated)


def remap_uid(uid: Column, salt: str, generated: bool = False) -> Column:
    """``2.25.`` and 128 bits of a hash as a decimal. An empty or null identifier stays."""
    # no branch holds the digits, for generated code finds once only what it always needs
    digits = F.sha2(F.concat(F.lit(f"{salt}|UID|"), F.nullif(uid, F.lit(""))).cast("binary"), 256)
    return F.coalesce(F.concat(F.lit("2.25."), once(digits, lambda x: decimal_text(x, generated), generated)), uid)


def without_fraction(time: Column) -> Column:
    return F.split_part(time, F.lit("."), F.lit(1))
