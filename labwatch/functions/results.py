"""Result text to the result code: 1 positive, 0 negative, -1 not tested, -2 unrecognised, -3 undetermined."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from labwatch.vocab import NEGATIVE, POSITIVE, UNDETERMINED, UNRECOGNISED

# A reading starts with a digit; only a plain decimal has a value.
_PLAIN_NUMBER = r"^[0-9]+([.][0-9]*)?([eE][+-]?[0-9]+)?[ ]*$"


def looks_numeric(c: Column) -> Column:
    return c.rlike("^[0-9]")


def reading(c: Column) -> Column:
    return F.when(c.rlike(_PLAIN_NUMBER), c.try_cast("double"))


def two_way(c: Column, cutoff: float | Column, unrecognised: int = UNRECOGNISED) -> Column:
    value = reading(c)
    return F.when(
        looks_numeric(c),
        F.when(value < cutoff, NEGATIVE).when(value >= cutoff, POSITIVE),
    ).otherwise(unrecognised)


def three_way(
    c: Column, low: float | Column, high: float | Column, undetermined: int = UNDETERMINED, unrecognised: int = UNRECOGNISED
) -> Column:
    value = reading(c)
    return F.when(
        looks_numeric(c),
        F.when(value <= low, NEGATIVE).when(value <= high, undetermined).when(value > high, POSITIVE),
    ).otherwise(unrecognised)


def register_pair(kind: Column, outcome: Column, wanted: int) -> Column:
    """Influenza is coded by a type column and an outcome column (1 yes, 2 no)."""
    return F.when((kind == wanted) & (outcome == 1), POSITIVE).when((kind == wanted) & (outcome == 2), NEGATIVE)


def any_positive(*codes: Column) -> Column:
    """Positive when one of the columns holds 1, otherwise no result."""
    hit = codes[0] == 1
    for c in codes[1:]:
        hit = hit | (c == 1)
    return F.when(hit, POSITIVE)


def row_max(*codes: Column) -> Column:
    """Highest code of the row, NULLs skipped."""
    return codes[0] if len(codes) == 1 else F.greatest(*codes)


def result_label(highest: Column) -> Column:
    """Code of a sample to its label. Unrecognised or foreign codes have no label."""
    return F.when(highest == 1, "Pos").when(highest == 0, "Neg").when(highest == -1, "NT")
