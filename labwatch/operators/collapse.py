"""One-hot pivot, per-sample collapse and keep-one de-duplication.

Every collapse is a two-phase aggregate: rows of one key meet in partial
aggregates on the map side first, so a key that owns a large share of the
rows sends one partial row per map task and never fills a reduce task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labwatch.functions.results import result_label
from labwatch.vocab import NOT_TESTED, PATHOGENS, RESULT_COLUMNS


def one_hot(df: DataFrame, analytes: Mapping[str, Sequence[str]], source: str, result: str = "result") -> DataFrame:
    """Add the 12 result columns: the row's code under its own pathogen, -1 under the others."""

    def code(pathogen: str) -> Column:
        names = analytes.get(pathogen)
        if not names:
            return F.lit(NOT_TESTED)
        return F.when(F.col(source).isin(list(names)), F.col(result)).otherwise(NOT_TESTED)

    return df.withColumns({f"{p}_test_result": code(p) for p in PATHOGENS})


def least_row(df: DataFrame, columns: Sequence[str], first: Sequence[str] = ("date_testing", "file_name")) -> Column:
    """The least row of a group over a total order: the named columns first, then all others."""
    order = [c for c in first if c in columns] + [c for c in columns if c not in first]
    return F.min(F.struct(*[F.col(c) for c in order]))


def keep_one(df: DataFrame, key: str | Sequence[str], first: Sequence[str] = ("date_testing", "file_name")) -> DataFrame:
    """One row per key, the least over all columns, so that the choice does not depend on row order."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    kept = df.groupBy(*keys).agg(least_row(df, rest, first).alias("_kept"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"_kept.{c}").alias(c) for c in df.columns])


def fill_and_keep_one(
    df: DataFrame,
    carried: Sequence[str],
    key: str = "sample_id",
    count_lines: bool = True,
    results: Sequence[str] = tuple(RESULT_COLUMNS),
) -> DataFrame:
    """Rows of one sample to one row: highest code per pathogen as its label, the least carried row, line count.

    A window per pathogen followed by a row number would give the same rows;
    the aggregate needs one exchange and combines before it.
    """
    highest = [F.max(c).alias(f"_max_{c}") for c in results]
    grouped = df.groupBy(key).agg(least_row(df, carried).alias("_kept"), *highest, F.count("*").alias("_lines"))
    lines = F.col("_lines") if count_lines else F.lit(1).cast("bigint")
    return grouped.select(
        key,
        *[F.col(f"_kept.{c}").alias(c) for c in carried],
        *[result_label(F.col(f"_max_{c}")).alias(c) for c in results],
        lines.alias("qty_original_lines"),
    )


def fill(df: DataFrame, key: str = "sample_id", results: Sequence[str] = tuple(RESULT_COLUMNS)) -> DataFrame:
    """Label every row with its sample's highest codes, keeping all rows.

    The per-sample maxima come from an aggregate and are joined back, which
    leaves a key with very many rows to AQE's skew-join splitting; a window
    would have to hold the whole key in one task.
    """
    maxima = df.groupBy(key).agg(
        *[F.max(c).alias(f"_max_{c}") for c in results], F.count("*").alias("qty_original_lines")
    )
    others = [c for c in df.columns if c not in results and c != key]
    return df.select(key, *others).join(maxima, key).select(
        key,
        *others,
        *[result_label(F.col(f"_max_{c}")).alias(c) for c in results],
        "qty_original_lines",
    )
