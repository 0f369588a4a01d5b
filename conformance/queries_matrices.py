"""Registered queries of the published tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from conformance import frames
from labwatch.plans import matrices


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def query(name: str) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: matrices.build_matrix(name, frames.source(spark, sf_dir, with_register="sivep" in name))

    return {name: query(name) for name in matrices.MATRICES}
