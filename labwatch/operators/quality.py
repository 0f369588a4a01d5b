"""Data checks. Each gives the failing rows or groups of a frame; ``report`` grades them.

Checks that need several passes in plain SQL are folded into one aggregate,
and nothing is collected: a report is itself a DataFrame.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labwatch import vocab
from labwatch.functions.dates import as_date
from labwatch.operators.joins import counts_per_week
from labwatch.vocab import PATHOGENS, RESULT_COLUMNS


def accepted_states(df: DataFrame, column: str = "state") -> DataFrame:
    return not_accepted(df, column, [*vocab.STATE_NAMES.values(), "NOT_REPORTED"])


def no_result(df: DataFrame, empty: object = "NT") -> DataFrame:
    """Rows without a single result; ``empty`` is ``'NT'`` for labels and -1 for codes."""
    return df.where(reduce(and_, [F.col(c) == empty for c in RESULT_COLUMNS]))


def not_exactly_one_result(df: DataFrame) -> DataFrame:
    """Rows whose 12 codes do not add up to those of one positive or one negative result.

    Two negatives add up to one positive and pass too, as the sums are all that is compared.
    """
    return df.where(~reduce(add, [F.col(c) for c in RESULT_COLUMNS]).isin(-11, -10))


def repeated_groups(df: DataFrame, columns: Sequence[str], most: int) -> DataFrame:
    """One row with the number of repeated groups when there are more than ``most``."""
    repeated = df.groupBy(*columns).agg(F.count("*").alias("_n")).where(F.col("_n") > 1)
    return repeated.agg(F.count("*").alias("repeated")).where(F.col("repeated") > most)


def unique_share(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct column tuples over rows. Tuples with NULLs count like any other; an empty frame has no share.

    Tuples are counted per group first and summed, which spreads the distinct
    over the cluster instead of holding it in one expansion.
    """
    groups = df.groupBy(*columns).agg(F.count("*").alias("_n"))
    totals = groups.agg(F.count("*").alias("_groups"), F.sum("_n").alias("_rows"))
    return totals.select((F.col("_groups").cast("double") / F.col("_rows")).alias("share"))


def unique_share_outside(df: DataFrame, columns: Sequence[str], low: float, high: float) -> DataFrame:
    return unique_share(df, columns).where((F.col("share") < low) | (F.col("share") > high))


def stale_pathogens(
    df: DataFrame, as_of: str | date, days: int = 5, pathogens: Sequence[str] = PATHOGENS
) -> DataFrame:
    """Pathogens whose newest tested sample is too old. A pathogen never tested passes."""
    newest = df.agg(*[F.max(F.when(F.col(f"{p}_test_result") != "NT", F.col("date_testing"))).alias(p) for p in pathogens])
    pairs = F.array(*[F.struct(F.lit(p).alias("pathogen"), F.col(p).alias("max_date_testing")) for p in pathogens])
    return newest.select(F.inline(pairs)).where(F.col("max_date_testing") < F.date_sub(as_date(as_of), days))


def fewer_rows_than(df: DataFrame, rows: int) -> DataFrame:
    return df.agg(F.count("*").alias("rows")).where(F.col("rows") < rows)


def repetitions_outside(df: DataFrame, column: str, low: int, high: int) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("repetitions")).where(~F.col("repetitions").between(low, high))


def weekly_rows_outside(df: DataFrame, weeks: DataFrame, as_of: str | date, low: int, high: int, days: int = 30) -> DataFrame:
    """Weeks begun in the last days whose number of rows is out of range, empty weeks included."""
    day = as_date(as_of)
    recent = weeks.where((F.col("start_date") >= F.date_sub(day, days)) & (F.col("start_date") <= day))
    return counts_per_week(df, recent.select("start_date", "end_date", "week_num")).where(
        ~F.col("test_count").between(low, high)
    )


def lost_lines(samples: DataFrame, lines: DataFrame, column: str = "qty_original_lines") -> DataFrame:
    """The surplus of counted lines over the lines that exist, when positive."""
    counted = samples.agg(F.sum(column).alias("counted"))
    existing = lines.agg(F.count("*").alias("existing")).scalar()
    return counted.select((F.col("counted") - existing).alias("diff_qty_lines")).where(F.col("diff_qty_lines") > 0)


def kit_fits(kits: Mapping[str, Sequence[str]] | None = None) -> Column:
    """Whether the tested pathogens are exactly those of the kit; NULL for an unknown kit.

    A missing result counts as tested, since only ``NT`` says otherwise.
    """
    wanted = kits or vocab.KIT_PATHOGENS
    bits = {p: 1 << i for i, p in enumerate(PATHOGENS)}
    tested = reduce(
        add, [F.when(F.col(f"{p}_test_result") == "NT", 0).otherwise(bit) for p, bit in bits.items()]
    )
    expected = F.create_map(
        *[F.lit(x) for kit, names in wanted.items() for x in (kit, sum(bits[p] for p in names))]
    )
    return F.try_element_at(expected, F.col("test_kit")) == tested


def kit_mismatches(df: DataFrame, kits: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Rows whose tested pathogens are not exactly those of their kit; an unknown kit is a mismatch."""
    return df.where(~F.coalesce(kit_fits(kits), F.lit(False)))


def nulls(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, NULL apart."""
    kept = df.where(F.col(column).isNotNull())
    return kept.groupBy(column).agg(F.count("*").alias("occurrences")).where(F.col("occurrences") > 1)


def not_accepted(df: DataFrame, column: str, accepted: Sequence[object]) -> DataFrame:
    return df.where(~F.col(column).isin(list(accepted)))


def forbidden(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    return df.where(F.col(column).isin(list(values)))


def outside_range(df: DataFrame, column: str, low: object, high: object) -> DataFrame:
    return df.where((F.col(column) < low) | (F.col(column) > high))


def not_null_share_below(df: DataFrame, column: str, least: float) -> DataFrame:
    share = df.agg(F.avg(F.col(column).isNotNull().cast("int")).alias("share"))
    return share.where(F.col("share") < least)


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str | None = None) -> DataFrame:
    """Child rows whose key is set and absent from the parent."""
    keys = parent.select(F.col(parent_column or column).alias("_key")).distinct()
    return child.where(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("_key"), "left_anti")


def unequal_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    counts = a.agg(F.count("*").alias("rows"))
    return counts.withColumn("other_rows", b.agg(F.count("*")).scalar()).where(F.col("rows") != F.col("other_rows"))


def violates(df: DataFrame, expression: Column) -> DataFrame:
    """Rows for which the expression is false or unknown."""
    return df.where(~F.coalesce(expression, F.lit(False)))


def missing_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Answered by the schema alone."""
    return [c for c in columns if c not in df.columns]


@dataclass(frozen=True)
class Check:
    """Failing rows of a model and how many of them warn or fail a build."""

    name: str
    model: str
    failing: DataFrame
    warn_above: int | None = None
    error_above: int | None = 0


def report(checks: Sequence[Check]) -> DataFrame:
    """check, model, failures, status (pass, warn or error), one row per check."""

    def graded(c: Check) -> DataFrame:
        n = F.col("failures")
        status = F.lit("pass")
        if c.warn_above is not None:
            status = F.when(n > c.warn_above, "warn").otherwise(status)
        if c.error_above is not None:
            status = F.when(n > c.error_above, "error").otherwise(status)
        return c.failing.agg(F.count("*").alias("failures")).select(
            F.lit(c.name).alias("check"), F.lit(c.model).alias("model"), "failures", status.alias("status")
        )

    return reduce(DataFrame.unionByName, [graded(c) for c in checks])
