"""Null-safe casts and keys out of text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of any kind, and marks that show nothing.
BLANKS = r"[\s\p{Z}\x{0085}\x{200B}-\x{200D}\x{2060}\x{FEFF}]"
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def stripped(col: Column) -> Column:
    """Text without white space (Unicode's too) at either end."""
    return F.regexp_replace(col, f"^{BLANKS}+|{BLANKS}+$", "")


def not_blank(col: Column) -> Column:
    """True for text with something other than white space of any kind; it is read up to that only."""
    return F.coalesce(col.rlike(f"[^{BLANKS[1:]}"), F.lit(False))


def safe_string(col: Column, default: str = "") -> Column:
    """Null becomes ``default``, anything else its text."""
    return F.coalesce(col.cast("string"), F.lit(default))


def safe_int(col: Column, default: int = 0) -> Column:
    """Whole part of a number in any notation as bigint; what is no finite number becomes ``default``."""
    return F.coalesce(col.cast("string").try_cast("double").try_cast("bigint"), F.lit(default).cast("bigint"))


def integer_key(col: Column) -> Column:
    """The bigint that a text stands for, however the number is written
    (`` 12``, ``12.0``, ``1.2E1``, ``00012``); null where it stands for none."""
    text = stripped(col.cast("string"))
    number = F.when(text.rlike(NUMBER), text).try_cast("decimal(38,18)")
    return F.when(number == F.floor(number), number.try_cast("bigint"))
