"""Date parsing where anything unreadable becomes null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: four-digit year, then month and day with an optional leading zero.
LOOSE_YMD = r"^(\d{4})(1[0-2]|0[1-9]|[1-9])(3[01]|[12]\d|0[1-9]|[1-9])$"

# Fixed value: a year of four digits, then nothing, a dash or a time.
FOUR_DIGIT_YEAR = r"^\s*\d{4}(\D|$)"


def from_yyyymmdd(number: Column) -> Column:
    """Date of a whole number YYYYMMDD; shorter forms such as 2026630 are read digit by digit."""
    text = number.cast("string")
    digits = F.length(text)
    parts = [F.substring(text, start, size) for start, size in ((1, 4), (5, 2), (7, 2))]
    loose = digits.isin(6, 7) & text.rlike(LOOSE_YMD)
    dashed = F.when(digits == 8, F.concat_ws("-", *parts)).when(
        loose, F.regexp_replace(text, LOOSE_YMD, "$1-$2-$3")
    )
    return dashed.try_cast("date")


def from_yyyymm(number: Column) -> Column:
    """First day of the month of a whole number YYYYMM."""
    sane = F.when(number.between(0, 10**10), number)
    return from_yyyymmdd(sane * 100 + 1)


def from_iso(value: Column) -> Column:
    """ISO date or date-time text, with a year of four digits, to date."""
    return F.when(value.cast("string").rlike(FOUR_DIGIT_YEAR), value.try_cast("date"))


def period(day: Column) -> Column:
    """Month key YYYYMM of a date."""
    return F.year(day) * 100 + F.month(day)


def period_of_short_year(year: Column, month: Column) -> Column:
    """Month key YYYYMM of a two-digit year and a month number."""
    return (F.lit(2000) + year) * 100 + month
