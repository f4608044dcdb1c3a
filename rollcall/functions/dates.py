"""Hire dates: sentinel decoding, parsing, year and quarter."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text that stands for a missing date, the length of the date
# part of an ISO-8601 text, and the date format (one or two digits accepted for
# month and day).
MISSING = "0"
DATE_CHARS = 10
DATE_FORMAT = "yyyy-M-d"

# A date part at full length, which a plain cast reads in half the time.
FULL_DATE = r"^\d{4}-\d\d-\d\d"


def decode_missing(text: Column) -> Column:
    return F.nullif(text, F.lit(MISSING))


def hire_date(text: Column, on_bad_date: str = "raise") -> Column:
    """Calendar date of an ISO-8601 text; ``'0'`` and null give null.

    With ``on_bad_date="raise"`` any other text fails the query, whatever the
    session's ANSI mode; with ``"null"`` it gives null.
    """
    if on_bad_date not in ("raise", "null"):
        raise ValueError(f"on_bad_date must be 'raise' or 'null', not {on_bad_date!r}")
    part = F.substring(text, 1, DATE_CHARS)
    short = decode_missing(part)
    date = F.when(text.rlike(FULL_DATE), part.try_cast("date")).otherwise(
        F.try_to_date(short, DATE_FORMAT)
    )
    if on_bad_date == "null":
        return date
    refuse = F.raise_error(F.concat(F.lit("not a calendar date: "), text)).cast("date")
    return F.when(short.isNotNull() & date.isNull(), refuse).otherwise(date)


def quarter_label(date: Column) -> Column:
    """``'Q1'`` to ``'Q4'``; null for a null date."""
    return F.concat(F.lit("Q"), F.quarter(date).cast("string"))


def in_year(date: Column, year: int) -> Column:
    """Year test as a date range, which Parquet statistics can answer."""
    return (date >= F.lit(dt.date(year, 1, 1))) & (date <= F.lit(dt.date(year, 12, 31)))
