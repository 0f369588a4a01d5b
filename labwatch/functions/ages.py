"""Ages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_age_text(c: Column, otherwise: int | None = None) -> Column:
    """``"95"``, ``"95A10M"`` -> 95; months or days -> 0; NULL -> NULL; other shapes -> ``otherwise``.

    Text made of no digits at all has no age to give and also reads as NULL.
    """
    years = F.split_part(c, F.lit("A"), F.lit(1)).try_cast("int")
    parsed = (
        F.when(c.isNull(), None)
        .when(c.rlike("^[0-9]*$"), c.try_cast("int"))
        .when(c.rlike("^[0-9]*A"), years)
        .when(c.rlike("^[0-9]*[MD]"), 0)
    )
    return parsed if otherwise is None else parsed.otherwise(otherwise)


def age_by_unit(value: Column, unit: Column) -> Column:
    """Unit 1 is days and 2 months, both under a year; 3 is years."""
    return F.when(unit.isin(1, 2), 0).when(unit == 3, value)


def completed_years(on: Column, born: Column) -> Column:
    """Full years lived on a day; whole years toward zero when the dates are swapped."""

    def ahead(end: Column, start: Column) -> Column:
        month_day = lambda d: F.month(d) * 100 + F.dayofmonth(d)
        return F.year(end) - F.year(start) - F.when(month_day(end) < month_day(start), 1).otherwise(0)

    return F.when(on >= born, ahead(on, born)).when(on < born, -ahead(born, on))


def clamp_age(c: Column, low: int | None = 0, high: int | None = 120) -> Column:
    outside = F.lit(False)
    if low is not None:
        outside = outside | (c < low)
    if high is not None:
        outside = outside | (c > high)
    return F.when(outside, None).otherwise(c)
