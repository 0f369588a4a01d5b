"""Unpivots, pivots, explosions and completion grids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labwatch.vocab import PATHOGENS


#: Columns that one generator computes. More code than about 8000 bytes in one method is left uncompiled by the JVM.
PER_GENERATOR = 4


def computed_once(df: DataFrame, *columns: str | Column) -> DataFrame:
    """A projection whose results are computed once per row.

    Catalyst pushes a filter on a computed column below its projection by
    repeating the computation, which for text cleaning read by many conditions
    multiplies the work and outgrows the code the JVM compiles. A filter is
    not pushed below a generator, so the columns pass through generators, a
    few through each: the code of one generator is one method, which is slow
    as long as it is too large to be compiled.
    """
    shares = [columns[i : i + PER_GENERATOR] for i in range(0, len(columns), PER_GENERATOR)]
    once = df
    for i, share in enumerate(shares):
        once = once.select("*", F.explode(F.array(F.struct(*share))).alias(f"_once{i}"))
    return once.select(*[f"_once{i}.*" for i in range(len(shares))])


def unpivot_results(df: DataFrame, keep: Sequence[str | Column] = ("*",), pathogens: Sequence[str] = PATHOGENS) -> DataFrame:
    """One row per (row, pathogen) with ``result`` and ``pathogen``; the wide columns may be kept beside them."""
    pairs = F.array(
        *[
            F.struct(F.col(f"{p}_test_result").alias("result"), F.lit(p).alias("pathogen"))
            for p in pathogens
        ]
    )
    return df.select(*keep, F.inline(pairs))


def unpivot_tested(df: DataFrame, keep: Sequence[str | Column]) -> DataFrame:
    """As :func:`unpivot_results` without the untested; a result that is NULL goes too."""
    return unpivot_results(df, keep).where(F.col("result") != "NT")


def lateral_rows(df: DataFrame, rows: Sequence[Mapping[str, Column]], keep: Sequence[str] = ("*",)) -> DataFrame:
    """A fixed list of computed tuples per row."""
    return df.select(*keep, F.inline(F.array(*[F.struct(*[v.alias(k) for k, v in row.items()]) for row in rows])))


def split_combined_test(
    df: DataFrame, is_combined: Column, is_plain: Column, outcomes: Mapping[str, tuple[str, str]],
    names: tuple[str, str], default: str = "UNKNOWN", test: str = "pathogen", result: str = "result",
) -> DataFrame:
    """One row of a two-pathogen test becomes two; plain rows pass; all others are dropped; no duplicates remain."""

    def outcome(position: int) -> Column:
        expr = None
        for text, pair in outcomes.items():
            cond, value = F.col(result) == text, F.lit(pair[position])
            expr = F.when(cond, value) if expr is None else expr.when(cond, value)
        return expr.otherwise(default)

    def tuples(*items: tuple[Column, Column]) -> Column:
        return F.array(*[F.struct(t.alias(test), r.alias(result)) for t, r in items])

    rows = F.when(is_combined, tuples(*[(F.lit(n), outcome(i)) for i, n in enumerate(names)])).when(
        is_plain, tuples((F.col(test), F.col(result)))
    )
    others = [c for c in df.columns if c not in (test, result)]
    return df.select(*others, F.inline(rows)).distinct()


def pivot_max(df: DataFrame, keys: Sequence[str], on: str, value: Column, names: Mapping[str, str]) -> DataFrame:
    """Value of each listed ``on`` under its own column, NULL where absent."""
    return df.groupBy(*keys).agg(*[F.max(F.when(F.col(on) == k, value)).alias(n) for k, n in names.items()])


def pivot_sum(df: DataFrame, keys: Sequence[str], on: str, value: Column, names: Mapping[str, str]) -> DataFrame:
    """Sum of each listed ``on`` under its own column, 0 where absent."""
    return df.groupBy(*keys).agg(
        *[F.sum(F.when(F.col(on) == k, value).otherwise(0)).alias(n) for k, n in names.items()]
    )


def distinct_values(df: DataFrame, column: str) -> list:
    """Sorted values of a column, for use as pivot columns: the driver sees one row for each column to come."""
    return sorted(r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().collect())


def calendar_values(df: DataFrame, bucket: str) -> Column:
    """The distinct buckets of a frame as one sorted array in a scalar subquery.

    For calendar buckets only: weeks, months and quarters are few by nature.
    """
    return df.agg(F.array_sort(F.collect_set(bucket))).scalar()


def complete_buckets(
    cells: DataFrame, place: Sequence[str], bucket: str, buckets: Column, fill: object = None
) -> DataFrame:
    """Every place of ``cells`` with every bucket, absent cells filled.

    ``cells`` has one row per (place, bucket). A place gathers its cells in a
    map, one entry per calendar bucket, and the buckets are exploded beside
    it. No join takes place and no pair is formed that is not in the result.
    """
    measures = [c for c in cells.columns if c != bucket and c not in place]
    entry = F.struct(F.col(bucket), F.struct(*[F.col(f"`{m}`") for m in measures]))
    held = cells.groupBy(*place).agg(F.map_from_entries(F.collect_list(entry)).alias("_held"))
    grid = held.select(*place, "_held", F.explode(buckets).alias(bucket))
    cell = F.try_element_at("_held", F.col(bucket))
    values = [cell.getField(m) for m in measures]
    if fill is not None:
        values = [F.coalesce(v, F.lit(fill)) for v in values]
    return grid.select(bucket, *place, *[v.alias(m) for v, m in zip(values, measures)])
