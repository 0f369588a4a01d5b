"""Counts and positivity per epidemiological week over an event stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labwatch.functions.metrics import positivity_rate


def epi_window(ts: Column) -> Column:
    """Seven-day windows that start on Sundays: the epoch began on a Thursday, three days before one."""
    return F.window(ts, "7 days", "7 days", "3 days")


def weekly_positivity(
    events: DataFrame, ts: str, is_positive: Column, is_negative: Column, by: Sequence[str] = (), lateness: str = "7 days",
    minimum: int = 50, event: str | None = None,
) -> DataFrame:
    """Weekly positives, negatives and rate. On a stream, a week is final once the watermark has passed it.

    In append mode each week is written once, when it is final; events that
    come later are dropped. ``event`` names the column that identifies an
    event: one that is delivered again counts once. A stream forgets an
    event when the watermark has passed it by the lateness, so its state is
    bounded; what is delivered again after that is late and is dropped as such.
    """
    timed = events.withWatermark(ts, lateness) if events.isStreaming else events
    if event:
        timed = timed.dropDuplicatesWithinWatermark([event]) if events.isStreaming else timed.dropDuplicates([event])
    counted = timed.groupBy(epi_window(F.col(ts)).alias("week"), *by).agg(
        F.sum(F.when(is_positive, 1).otherwise(0)).alias("pos"),
        F.sum(F.when(is_negative, 1).otherwise(0)).alias("neg"),
        F.count("*").alias("events"),
    )
    return counted.select(
        F.to_date("week.start").alias("epiweek_start"),
        F.date_sub(F.to_date("week.end"), 1).alias("epiweek_enddate"),
        *by,
        "pos",
        "neg",
        "events",
        positivity_rate(F.col("pos"), F.col("neg"), minimum).alias("posrate"),
    )
