"""Safe scalar conversions: a bad value becomes NULL, never an error (ANSI mode is on)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The warehouse's NUMERIC: 38 digits, 9 after the point.
NUMERIC = "decimal(38,9)"

_BLANKS = " \t\r\n\f\v"
_US_DATE = r"^\d{1,2}/\d{1,2}/\d{1,4}$"


def safe_parse_date(text: Column) -> Column:
    """Month/day/year text to DATE. Surrounding blanks and unpadded numbers are fine.

    A year is taken as it is written: 23 is the year 23, as strptime's %Y has it.

    The shape test keeps text that cannot be a date away from the parser, whose
    failure path builds an exception per row.
    """
    trimmed = F.btrim(text, F.lit(_BLANKS))
    return F.when(trimmed.rlike(_US_DATE), F.try_to_date(trimmed, "M/d/y"))


def safe_cast_numeric(value: Column) -> Column:
    """Any number or numeric text to NUMERIC; NaN, infinities and overflow give NULL."""
    return value.try_cast(NUMERIC)


def month_of(day: Column) -> Column:
    """First day of the month, as a DATE (no time zone involved)."""
    return F.trunc(day, "MM")
