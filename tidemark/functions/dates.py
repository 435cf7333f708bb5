"""Month and day parsing.  Bad text gives NULL, so one bad row never stops a build."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# First valid_from of every dimension key, and the open end of a version.
BEGINNING = "1900-01-01 00:00:00"
OPEN_END = "9999-12-31 00:00:00"


def ntz(text: str) -> Column:
    """Timestamp literal without zone, so the session zone never shifts a validity bound."""
    return F.lit(text).cast("timestamp_ntz")


def _day(year: Column, month: Column, day: Column) -> Column:
    """Date from text parts.  A cast reads year-month-day far faster than a pattern does."""
    return F.concat_ws("-", year, month, day).try_cast("date")


def _times(mark: str, text: Column) -> Column:
    """How often a character is found; counting costs less than a split."""
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def month_start(month_text: Column) -> Column:
    """'MM_YYYY' to the first day of that month."""
    day = _day(F.substring_index(month_text, "_", -1), F.substring_index(month_text, "_", 1),
               F.lit("01"))
    return F.when(_times("_", month_text) == 1, day)


def iso_day(text: Column) -> Column:
    return text.try_cast("date")


def day_first(text: Column) -> Column:
    """Day-first text, with or without leading zeros."""
    month = F.substring_index(F.substring_index(text, "/", 2), "/", -1)
    day = _day(F.substring_index(text, "/", -1), month, F.substring_index(text, "/", 1))
    return F.when(_times("/", text) == 2, day)


def clamp_to_month(day: Column, month: Column) -> Column:
    """A day after its month becomes the month's last day; earlier days are left alone.

    ``least`` skips NULL, so a missing day becomes the month end.
    """
    return F.least(day, F.last_day(month))


def is_after_month(day: Column, month: Column) -> Column:
    return day > F.last_day(month)
