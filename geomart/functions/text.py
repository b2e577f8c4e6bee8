"""Text and number expressions. Everything is a built-in Column expression."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What counts as a missing text, and as blank space around a value.
NULL_TOKENS = ("", "nan", "None")
BLANKS = " \t\n\r\x0b\x0c\x85\xa0\u2002\u2003\u2009\u3000"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def clean_text(c: Column, null_tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """Trimmed text; the tokens that stand for a missing value become NULL."""
    text = strip(c.cast("string"))
    return F.when(~text.isin(*null_tokens), text)


def to_number(c: Column, kind: T.DataType | None = None) -> Column:
    """Text to double; what is not a number (NaN included) becomes NULL.

    The cast trims blanks itself. It would also take Java's float suffixes (``1.0d``), so
    those letters, which no decimal number holds, are spoiled first. Where ``kind``, the type of ``c`` if it is known, is a whole
    number or a double, the value comes without the way through its text, which takes most of the time of a wide table.
    """
    if isinstance(kind, T.IntegralType):
        return c.cast("double")
    if isinstance(kind, T.DoubleType):
        return F.when(F.abs(c) < float("inf"), c)  # NaN is above infinity
    text = F.translate(c.cast("string"), "dDfF", "####")
    return F.nanvl(text.try_cast("double"), F.lit(None).cast("double"))


def to_whole_number(c: Column, kind: T.DataType | None = None) -> Column:
    """Text to long; a number with a fraction becomes NULL."""
    number = to_number(c, kind)
    return F.when(number == F.floor(number), number.try_cast("long"))


def parse_currency(c: Column) -> Column:
    """``$1,060 `` to 1060.0."""
    return to_number(F.translate(c.cast("string"), "$,", ""))


def flag_from_map(c: Column, values: Mapping[str, bool]) -> Column:
    """Text to boolean by a small map; anything else becomes NULL."""
    yes = [k for k, v in values.items() if v]
    no = [k for k, v in values.items() if not v]
    return F.when(c.isin(*yes), F.lit(True)).when(c.isin(*no), F.lit(False))


def flag_from_text(c: Column) -> Column:
    """Case-blind ``true`` / ``false`` text to boolean; anything else becomes NULL."""
    return flag_from_map(F.upper(c.cast("string")), {"TRUE": True, "FALSE": False})


def is_true_text(c: Column) -> Column:
    """True exactly for case-blind ``true``; NULL gives false."""
    return F.coalesce(F.lower(c.cast("string")) == "true", F.lit(False))


def keep_letters_digits(c: Column) -> Column:
    """Drop every character but ASCII letters, digits and blank space."""
    return F.regexp_replace(c, "[^a-zA-Z0-9" + BLANKS + "]", "")


def drop_comma_space(c: Column) -> Column:
    return F.replace(c, F.lit(", "), F.lit(""))


def first_part(c: Column, separator: str = ",") -> Column:
    return F.split_part(c, F.lit(separator), F.lit(1))


def join_parts(parts: Column, separator: str = ", ") -> Column:
    return F.concat_ws(separator, parts)
