"""Dates as days, as ``yyyyMMdd`` integers and as ISO text."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# The day that stands for "no date", as a date and as an integer key.
SENTINEL_DATE = datetime.date(2262, 4, 11)
SENTINEL_KEY = 22620411


def parse_date(c: Column, fmt: str = "M/d/yyyy") -> Column:
    """Text to date by one declared format; a bad text becomes NULL."""
    return F.try_to_date(F.trim(c.cast("string")), fmt)


def fill_sentinel(c: Column) -> Column:
    return F.coalesce(c.cast("date"), F.lit(SENTINEL_DATE))


def date_key(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd").cast("int")


def date_from_key(c: Column) -> Column:
    """Integer ``yyyyMMdd`` to date; a number that is no date becomes NULL."""
    return F.try_to_date(c.cast("string"), "yyyyMMdd")


def iso_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")


def iso_utc_from_key(c: Column, sentinel: int = SENTINEL_KEY) -> Column:
    """Integer date to ISO text ending in Z; the sentinel and bad numbers become NULL."""
    return F.date_format(date_from_key(F.nullif(c.try_cast("int"), F.lit(sentinel))), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def date_parts(c: Column) -> dict[str, Column]:
    return {
        "year": F.year(c),
        "month": F.month(c),
        "day": F.dayofmonth(c),
        "day_of_week": F.date_format(c, "EEEE"),
        "month_name": F.date_format(c, "MMMM"),
    }
