"""Keyed merges on plain file tables.

The merge is planned for a batch much smaller than its table. Untouched rows
come from an anti join and the creation times of touched rows from an inner
join that reads two columns, so a batch under the broadcast threshold never
makes the table move; a larger one turns both into sort-merge joins. A full
outer join would shuffle every column of the table in either case.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labwatch.vocab import RESULT_COLUMNS


def stamp(df: DataFrame, now: Column) -> DataFrame:
    return df.withColumns({"created_at": now, "updated_at": now})


def merge(target: DataFrame | None, source: DataFrame, key: str = "sample_id", keep: Sequence[str] = ("created_at",)) -> DataFrame:
    """Insert new keys and overwrite known ones, except the ``keep`` columns. Both sides are unique per key."""
    if target is None:
        return source
    kept = target.select(key, *[F.col(c).alias(f"_old_{c}") for c in keep], F.lit(True).alias("_known"))
    touched = kept.join(source.select(key), key)
    merged = source.join(touched, key, "left").select(
        *[
            F.when(F.col("_known"), F.col(f"_old_{c}")).otherwise(F.col(c)).alias(c) if c in keep else F.col(c)
            for c in source.columns
        ]
    )
    untouched = target.join(source.select(key), key, "left_anti")
    return untouched.unionByName(merged)


def keep_decisive(
    target: DataFrame | None, source: DataFrame, key: str = "sample_id", results: Sequence[str] = tuple(RESULT_COLUMNS)
) -> DataFrame:
    """Replace a source result by the known one unless that is NULL or ``NT``. A missing table counts as empty."""
    if target is None:
        return source
    known = target.select(key, *[F.col(c).alias(f"_old_{c}") for c in results]).join(source.select(key), key)
    return source.join(known, key, "left").select(
        *[
            F.when((F.col(f"_old_{c}") == "NT") | F.col(f"_old_{c}").isNull(), F.col(c)).otherwise(F.col(f"_old_{c}")).alias(c)
            if c in results
            else F.col(c)
            for c in source.columns
        ]
    )
