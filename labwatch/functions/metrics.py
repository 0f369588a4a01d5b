"""Positivity arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# a rate is published from this many conclusive tests on
MINIMUM_TESTS = 50


def is_positive(result: Column) -> Column:
    return F.when(result == "Pos", 1).otherwise(0)


def is_negative(result: Column) -> Column:
    return F.when(result == "Neg", 1).otherwise(0)


def positivity_rate(pos: Column, neg: Column, minimum: int = MINIMUM_TESTS) -> Column:
    """Share of positives among conclusive tests, NULL below the minimum."""
    total = pos + neg
    return F.when(total >= minimum, pos.cast("double") / total)


def positivity(result: Column, minimum: int = MINIMUM_TESTS) -> list[Column]:
    """The four measures of a result column, to be passed to ``agg``."""
    pos, neg = F.sum(is_positive(result)), F.sum(is_negative(result))
    return [
        pos.alias("Pos"),
        neg.alias("Neg"),
        (pos + neg).alias("totaltests"),
        positivity_rate(pos, neg, minimum).alias("posrate"),
    ]


def per_100k(cases: Column, population: Column) -> Column:
    return cases.cast("double") / F.nullif(population, F.lit(0)) * 100000


def half_up(c: Column) -> Column:
    return F.floor(c + 0.5).cast("int")


def thousands_dot(c: Column) -> Column:
    """``1234567`` -> ``1.234.567``."""
    return F.translate(F.format_number(c, 0), ",", ".")
