"""Registered queries of the laboratories, the register and the archive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from conformance import frames
from conformance import testbed as tb
from labwatch.functions.dates import local_time
from labwatch.plans import archive
from labwatch.plans.labs import LABS


def now() -> Column:
    return local_time(F.lit(tb.NOW).cast("timestamp"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def lab(lab_id: str) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: LABS[lab_id].wide(tb.raw(spark, sf_dir, lab_id))

    return {
        **{f"lab_{lab_id.lower()}": lab(lab_id) for lab_id in LABS},
        "register_samples": frames.register_samples,
        "archive_samples": lambda spark, sf_dir: archive.final(tb.raw_archive(spark, sf_dir), now()),
    }
