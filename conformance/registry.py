"""All registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from conformance import oracle_labs, oracle_matrices, queries_io, queries_labs, queries_matrices, queries_operators, queries_quality  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**queries_operators.QUERIES, **queries_labs.queries(), **queries_matrices.queries()}


def oracle_sql() -> dict[str, str]:
    return {**queries_operators.SQL, **oracle_labs.sql(), **oracle_matrices.sql()}
