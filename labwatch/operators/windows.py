"""Running totals, row picks and rankings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_total(value: str, by: Sequence[str], order: str) -> Column:
    """Sum up to and including the peers of the current row.

    Meant for counts already aggregated to (place, bucket): a partition then
    holds one row per bucket of the calendar.
    """
    return F.sum(value).over(Window.partitionBy(*by).orderBy(order))


def top_k(df: DataFrame, by: Sequence[str], score: str, k: int, ties: Sequence[str]) -> DataFrame:
    """The k best rows per group with ties broken by name.

    Spark prunes each map task to k rows per group before the exchange when
    the rank is filtered by a constant, so large groups stay small.
    """
    order = Window.partitionBy(*by).orderBy(F.desc(score), *[F.asc(t) for t in ties])
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def sort_like_postgres(df: DataFrame, *keys: tuple[str, str], last: Sequence[str] | None = None) -> DataFrame:
    """Global sort with NULLs last when ascending and first when descending.

    Rows with equal keys follow ``last``, by default all other columns: the
    order is the same in every run, and the ranges of the sort can part rows
    whose keys are equal instead of giving them all to one task.
    """
    if last is None:
        last = [c for c in df.columns if c not in {k for k, _ in keys}]
    ways = [F.col(f"`{c}`").desc_nulls_first() if way == "desc" else F.col(f"`{c}`").asc_nulls_last() for c, way in keys]
    return df.orderBy(*ways, *[F.col(f"`{c}`").asc_nulls_last() for c in last])
