"""Row filters with SQL's three-valued logic: a condition that is NULL drops the row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labwatch.functions.dates import as_date
from labwatch.vocab import RESULT_COLUMNS


def any_informative(columns: Sequence[str], uninformative: Sequence[str] = ("INCONCLUSIVO",)) -> Column:
    """At least one column holds a value outside the uninformative ones."""
    return reduce(or_, [F.col(c).isNotNull() & ~F.col(c).isin(list(uninformative)) for c in columns])


def not_all_untested(columns: Sequence[str] = tuple(RESULT_COLUMNS)) -> Column:
    return ~reduce(and_, [F.col(c) == "NT" for c in columns])


def routed(branches: Sequence[tuple[Column, Column]]) -> Column:
    """The first branch whose test holds decides with its own condition; no branch, no row."""
    (test, verdict), *rest = branches
    expr = F.when(test, verdict)
    for test, verdict in rest:
        expr = expr.when(test, verdict)
    return expr.otherwise(False)


def is_tested(column: str) -> Column:
    return F.col(column).isin("Pos", "Neg")


def between_days(column: str, after: str | None = None, before: str | None = None, from_: str | None = None) -> Column:
    """Strictly after, strictly before, or from a day on."""
    conds = []
    if after:
        conds.append(F.col(column) > as_date(after))
    if from_:
        conds.append(F.col(column) >= as_date(from_))
    if before:
        conds.append(F.col(column) < as_date(before))
    return reduce(and_, conds)


def without_groups(df: DataFrame, bad: DataFrame, key: str) -> DataFrame:
    """Drop all rows of the keys that occur in ``bad``."""
    return df.join(bad.select(key).distinct(), key, "left_anti")


def recent(df: DataFrame, column: str, days: int) -> DataFrame:
    """Rows less than ``days`` days before the newest day of the frame."""
    return df.where(F.col(column) > F.date_sub(df.agg(F.max(column)).scalar(), days))


def latest(df: DataFrame, column: str) -> DataFrame:
    """Rows of the newest day."""
    return df.where(F.col(column) >= df.agg(F.max(column)).scalar())
