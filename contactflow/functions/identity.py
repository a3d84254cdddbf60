"""National id, check digit, sex, phone, date and age expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WHITESPACE, blank_to_null, trim_ws

MAX_ID_DIGITS = 8


def rut_digits(c: Column, split_dv: bool = False) -> Column:
    """Digits of a national id without leading zeros, '' if there is none.

    Dots and dashes vanish, then only the first word counts. With `split_dv`
    a trailing dash and check digit is cut off first. Jobs filter on this
    form: the optimizer repeats a filtered expression once per mention, and
    turning '' into NULL would mention it twice.
    """
    v = trim_ws(c)
    if split_dv:
        v = F.regexp_replace(v, "-[0-9Kk]$", "")
    v = F.ltrim(F.translate(v, ".-", ""), F.lit(WHITESPACE))
    return F.regexp_extract(v, r"(?U)^0*([0-9]+)(?:\s|$)", 1)


def normalize_rut(c: Column, split_dv: bool = False) -> Column:
    """Digits of a national id without leading zeros, or NULL."""
    return blank_to_null(rut_digits(c, split_dv))


def is_storable(digits: Column) -> Column:
    """A key of one to eight digits."""
    return F.length(digits).isin(*range(1, MAX_ID_DIGITS + 1))


def normalize_dv(c: Column) -> Column:
    v = F.upper(trim_ws(c))
    return F.when(v.isin([*"0123456789", "K"]), v)


def normalize_sex(c: Column) -> Column:
    v = F.upper(trim_ws(c))
    return F.when(v.isin("MUJER", "F"), F.lit("F")).when(v.isin("VARON", "VARÓN", "M"), F.lit("M"))


def parse_date(c: Column) -> Column:
    """`yyyyMMdd`, or `yyyy-M-d` in the first ten characters; else NULL."""
    v = trim_ws(c)
    packed = F.concat_ws(
        "-", F.substring(v, 1, 4), F.substring(v, 5, 2), F.substring(v, 7, 2)
    ).try_cast("date")
    head = F.substring(v, 1, 10)
    return F.when(v.rlike(r"^(?!0000)[0-9]{8}$"), packed).when(
        head.rlike(r"^(?!0000)[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), head.try_cast("date")
    )


def phone_digits(c: Column) -> Column:
    """Nine digits, a leading 9 added to eight; '' for anything else."""
    digits = F.regexp_replace(c, "[^0-9]", "")
    # With a 9 in front, nine or ten digits are left of a usable number.
    return F.regexp_extract(F.concat(F.lit("9"), digits), "^9?([0-9]{9})$", 1)


def normalize_phone(c: Column) -> Column:
    """Nine digits; eight get a leading 9; anything else is NULL."""
    return blank_to_null(phone_digits(c))


def age_on(birth: Column, today: Column) -> Column:
    """Completed years as text, '' without a birth date."""
    def month_day(d):
        return F.month(d) * 100 + F.dayofmonth(d)

    years = F.year(today) - F.year(birth) - (month_day(today) < month_day(birth)).cast("int")
    return F.coalesce(years.cast("string"), F.lit(""))


def print_date(c: Column) -> Column:
    return F.coalesce(F.date_format(c, "dd/MM/yyyy"), F.lit(""))


def month_key(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def month_label(c: Column) -> Column:
    return F.date_format(c, "MM/yyyy")
