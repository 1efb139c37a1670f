"""Cleaning of zipcodes, prices, rents and areas that arrive as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lettora.params import TextPatterns

PATTERNS = TextPatterns()


def format_zipcode(code: Column, pattern: str = PATTERNS.zipcode) -> Column:
    """``1234AB`` -> ``1234 AB``; texts of 4 or 7 characters stay; any other length, and NULL, gives NULL."""
    size = F.length(code)
    return F.when(size.isin(4, 7), code).when(size == 6, F.regexp_replace(code, pattern, "$1 $2"))


def pc4(code: Column, pattern: str = PATTERNS.pc4) -> Column:
    """First run of four digits; ``""`` when there is none, NULL for NULL."""
    return F.regexp_extract(code, pattern, 1)


def has_pc4(code: Column, pattern: str = PATTERNS.pc4) -> Column:
    """False both for texts without a PC4 and (as NULL) for NULL, so usable as a filter."""
    return pc4(code, pattern) != ""


def to_double(text: Column) -> Column:
    """Lenient number: text that is not a number becomes NULL, in ANSI mode too."""
    return text.try_cast("double")


def rent_amount(rent: Column, pattern: str = PATTERNS.rent) -> Column:
    """Digits after the euro sign (up to the first separator) as a double, else NULL."""
    return to_double(F.regexp_extract(rent, pattern, 1))


def area_amount(area: Column, pattern: str = PATTERNS.area) -> Column:
    """First run of digits as a double, else NULL."""
    return to_double(F.regexp_extract(area, pattern, 1))


def utilities_included(rent: Column, marker: str = PATTERNS.utilities) -> Column:
    """Case-sensitive substring flag; NULL for NULL."""
    return rent.contains(marker)


def blank_to_null(text: Column) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(F.trim(text), F.lit(""))
