"""Text to typed values. Text that does not fit becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_rounded_int(c: Column) -> Column:
    """``"3.0"`` -> 3 and ``"3.6"`` -> 4: round half away from zero, as a numeric cast does."""
    return F.round(c.try_cast("decimal(38,6)")).cast("int")


def to_int(c: Column) -> Column:
    return F.trim(c).try_cast("int")


def integer_text(c: Column) -> Column:
    """Canonical text of a whole number: ``"007"`` -> ``"7"``."""
    return F.trim(c).try_cast("bigint").cast("string")


def to_date(c: Column, pattern: str) -> Column:
    """Day at the start of the text. A time after it is ignored; ``d/M/yyyy`` also reads two-digit fields."""
    leading = F.regexp_extract(c, r"^\s*([0-9]+[-/][0-9]+[-/][0-9]+)", 1)
    return F.try_to_date(leading, pattern)


def to_mixed_date(c: Column, *patterns: str) -> Column:
    """First pattern that fits, decided row by row."""
    return F.coalesce(*[to_date(c, p) for p in patterns])


def digits_only(c: Column) -> Column:
    """Whole text made of digits."""
    return c.rlike("^[0-9]+$")
