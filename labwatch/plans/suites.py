"""The checks that each laboratory's table and the panel carry, graded from one pass over the rows.

A rule names failing rows, or a few figures from which its failures follow.
All figures of a suite are aggregates that can be merged, so they are taken
in one pass: either by an ``Observation`` while the table is being written, or
by one aggregate over the key, which finds repeated keys on the way. Samples
leave their plan dealt by that key, so this adds no exchange of rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from labwatch import vocab
from labwatch.functions.dates import as_date, week_start
from labwatch.operators.quality import kit_fits
from labwatch.vocab import PATHOGENS, RESULT_COLUMNS

DAY = "date_testing"
#: Days back of the weekly volumes and of the freshness of results.
VOLUME_DAYS, FRESH_DAYS = 30, 5


@dataclass(frozen=True)
class Rule:
    """One check. More than ``warn`` failures warn and more than ``error`` fail; None never does."""

    kind: str
    column: str = ""
    values: tuple = ()
    low: float | None = None
    high: float | None = None
    days: int | None = None
    warn: int | None = None
    error: int | None = 0

    @property
    def name(self) -> str:
        return "_".join(filter(None, [self.kind, self.column, f"last_{self.days}_days" if self.days else ""]))


@dataclass(frozen=True)
class Suite:
    model: str
    rules: tuple[Rule, ...]
    key: str = "sample_id"


def warns(kind: str, column: str = "", **more: object) -> Rule:
    return Rule(kind, column, warn=0, error=None, **more)


def missing_most(column: str, warn: int, error: int, days: int | None = None) -> Rule:
    return Rule("not_null", column, days=days, warn=warn, error=error)


KEYS = (Rule("not_null", "sample_id"), Rule("unique", "sample_id"))
RESULTS = tuple(r for c in RESULT_COLUMNS for r in (Rule("not_null", c), Rule("accepted", c, ("Pos", "Neg", "NT"))))
SEX = Rule("accepted", "sex", ("M", "F"))
NOT_AHEAD = Rule("past", DAY)
STATES = Rule("accepted", "state", (*vocab.STATE_NAMES.values(), "NOT_REPORTED"))
FRESH = (warns("fresh", values=tuple(PATHOGENS)), warns("fresh", "main", values=("SC2", "VSR", "FLUA", "FLUB")))


def kits(*names: str) -> tuple[Rule, ...]:
    return Rule("not_null", "test_kit"), Rule("forbidden", "test_kit", ("UNKNOWN",)), Rule("accepted", "test_kit", names)


def ages(highest: int) -> Rule:
    return Rule("range", "age", low=0, high=highest)


def lines(most: int) -> Rule:
    return Rule("range", "qty_original_lines", low=1, high=most)


def weekly(low: int, high: int) -> Rule:
    return warns("weeks", low=low, high=high)


BASIC = (Rule("any_result"), Rule("not_null", "test_id"), *KEYS, *RESULTS)

# Kits, bounds and severities of each laboratory's checks.
SUITES: dict[str, Suite] = {
    s.model: s
    for s in [
        Suite("HILAB", BASIC),
        Suite("HLAGYN", BASIC),
        Suite("FLEURY", (Rule("any_result"), *KEYS)),
        Suite(
            "SABIN",
            (*BASIC, *kits("covid_pcr", "covid_antigen", "test_4", "test_21", "test_24"), ages(150), NOT_AHEAD, Rule("accepted", "qty_original_lines", (21, 42, 26, 4, 2, 1))),
        ),
        Suite(
            "EINSTEIN",
            (
                *BASIC, *kits("covid_pcr", "covid_antigen", "vsr_antigen", "test_3", "test_4", "flu_antigen"), ages(120), warns("share", "age", low=0.95),
                NOT_AHEAD, lines(5), weekly(500, 3000), *FRESH,
            ),
        ),
        Suite(
            "HPARDINI",
            (
                *BASIC, *kits("covid_pcr", "covid_antigen", "vsr_antigen", "test_3", "test_4", "flu_antigen"), ages(120), warns("share", "age", low=0.95),
                missing_most("age", 10, 100, 7), STATES, missing_most("state", 10, 100, 7), missing_most("state", 10, 100), SEX, warns("not_null", DAY), NOT_AHEAD,
                lines(25), weekly(50, 3000), *FRESH, Rule("kit"),
            ),
        ),
        Suite(
            "DBMOL",
            (
                *BASIC,
                *kits(
                    "sc2_antigen", "adeno_test", "covid_antigen", "bac_igg", "bac_igm", "bac_antigen", "test_2", "test_4", "bac_test", "flua_igm", "sc2_igg", "adeno_igg",
                    "vsr_igg", "flub_igm", "flua_igg", "flu_pcr", "test_24", "flub_igg", "adeno_antigen", "adeno_igm", "bac_iga", "bac_pcr", "bac_antibodies", "adeno_pcr",
                    "adeno_iga", "covid_antibodies", "covid_iga",
                ),
                Rule("not_null", DAY), NOT_AHEAD, ages(200), missing_most("age", 10, 100, 7), STATES, missing_most("state", 10, 100, 7), missing_most("state", 100, 1000), SEX,
                lines(25), weekly(500, 3000), *FRESH,
            ),
        ),
        Suite(
            "TARGET",
            (
                *BASIC, *kits("covid_pcr", "test_4", "test_23"), Rule("not_null", DAY), NOT_AHEAD, ages(200), missing_most("age", 10, 100, 7), missing_most("age", 100, 1000),
                missing_most("state", 10, 100, 7), missing_most("state", 100, 1000), SEX, lines(23), weekly(500, 3000), *FRESH,
            ),
        ),
        Suite("PANEL", (Rule("unique", "sample_id"), Rule("not_null", "test_kit"))),
    ]
}


def _weeks(as_of: date) -> list[date]:
    """Sundays of the last days."""
    return [d for d in (as_of - timedelta(days=i) for i in range(VOLUME_DAYS + 1)) if d.isoweekday() == 7]


def failing(rule: Rule, as_of: date) -> Column | None:
    """The rows that fail a rule about single rows."""
    c = F.col(rule.column) if rule.column else None
    today = as_date(as_of)
    if rule.kind == "not_null":
        return c.isNull() & (F.col(DAY) > F.date_sub(today, rule.days)) if rule.days else c.isNull()
    if rule.kind == "accepted":
        return ~c.isin(list(rule.values))
    if rule.kind == "forbidden":
        return c.isin(list(rule.values))
    if rule.kind == "range":
        return (c < rule.low) | (c > rule.high)
    if rule.kind == "past":
        return c > today
    if rule.kind == "any_result":
        return reduce(and_, [F.col(r) == "NT" for r in RESULT_COLUMNS])
    if rule.kind == "kit":
        return ~F.coalesce(kit_fits(), F.lit(False))
    return None


def figures(rule: Rule, as_of: date) -> dict[str, tuple[Column, str]]:
    """What one pass has to take for a rule: name, aggregate, and how two of its values merge."""
    rows = failing(rule, as_of)
    if rows is not None:
        return {"n": (F.count(F.when(rows, 1)), "sum")}
    if rule.kind == "share":
        return {"n": (F.count("*"), "sum"), "some": (F.count(rule.column), "sum")}
    if rule.kind == "fresh":
        return {p: (F.max(F.when(F.col(f"{p}_test_result") != "NT", F.col(DAY))), "max") for p in rule.values}
    if rule.kind == "weeks":
        week = week_start(F.col(DAY))
        return {f"w{i}": (F.count(F.when(week == as_date(w), 1)), "sum") for i, w in enumerate(_weeks(as_of))}
    return {}  # repeated keys are found by grouping


def failures(rule: Rule, at: str, as_of: date) -> Column:
    """Failures of a rule from its figures, named after ``at``."""
    part = lambda name: F.col(f"{at}_{name}")
    if rule.kind == "share":
        return F.when(part("some") < rule.low * part("n"), 1).otherwise(0)
    if rule.kind == "fresh":
        old = F.date_sub(as_date(as_of), FRESH_DAYS)
        return reduce(add, [F.when(part(p) < old, 1).otherwise(0) for p in rule.values])
    if rule.kind == "weeks":
        return reduce(add, [F.when(part(f"w{i}").between(rule.low, rule.high), 0).otherwise(1) for i in range(len(_weeks(as_of)))])
    return F.col("repeated") if rule.kind == "unique" else part("n")


def _figures(suite: Suite, as_of: date) -> dict[str, tuple[Column, str]]:
    return {f"r{i}_{name}": figure for i, rule in enumerate(suite.rules) for name, figure in figures(rule, as_of).items()}


def _graded(row: DataFrame, suite: Suite, as_of: date) -> DataFrame:
    """check, model, failures, status from one row of figures."""

    def line(i: int, rule: Rule) -> Column:
        n = failures(rule, f"r{i}", as_of).cast("bigint")
        status = F.lit("pass")
        if rule.warn is not None:
            status = F.when(n > rule.warn, "warn").otherwise(status)
        if rule.error is not None:
            status = F.when(n > rule.error, "error").otherwise(status)
        return F.struct(F.lit(rule.name).alias("check"), F.lit(suite.model).alias("model"), n.alias("failures"), status.alias("status"))

    return row.select(F.inline(F.array(*[line(i, rule) for i, rule in enumerate(suite.rules)])))


def as_day(as_of: str | date) -> date:
    return as_of if isinstance(as_of, date) else date.fromisoformat(as_of)


def grade(df: DataFrame, suite: Suite, as_of: str | date) -> DataFrame:
    """check, model, failures, status: one row per rule, from one pass over ``df``.

    An empty frame passes the rules about rows and fails those about volume.
    """
    day = as_day(as_of)
    taken = _figures(suite, day)
    keyed = df.groupBy(suite.key).agg(F.count("*").alias("_rows"), *[a.alias(name) for name, (a, _) in taken.items()])
    merged = {name: F.sum(name) if how == "sum" else F.max(name) for name, (_, how) in taken.items()}
    # an empty frame has no groups, hence no sums
    zero = {name: F.coalesce(merged[name], F.lit(0)).alias(name) if how == "sum" else merged[name].alias(name) for name, (_, how) in taken.items()}
    repeated = F.count(F.when((F.col("_rows") > 1) & F.col(suite.key).isNotNull(), 1)).alias("repeated")
    return _graded(keyed.agg(repeated, *zero.values()), suite, day)


def write_checked(df: DataFrame, path: str, suite: Suite, as_of: str | date) -> DataFrame:
    """Write a table as parquet and grade it by what an ``Observation`` saw on the way.

    Repeated keys are counted on the key column of what was written.
    """
    day, spark, seen = as_day(as_of), df.sparkSession, Observation(f"suite {suite.model}")
    taken = _figures(suite, day)
    df.observe(seen, *[a.alias(name) for name, (a, _) in taken.items()]).write.mode("overwrite").parquet(path)
    values = seen.get
    kinds = {name: "date" if how == "max" else "bigint" for name, (_, how) in taken.items()}
    row = spark.createDataFrame([tuple(values[n] for n in kinds)], ", ".join(f"{n} {t}" for n, t in kinds.items()))
    if any(rule.kind == "unique" for rule in suite.rules):
        keys = spark.read.parquet(path).where(F.col(suite.key).isNotNull()).groupBy(suite.key).agg(F.count("*").alias("_rows"))
        row = row.withColumn("repeated", keys.where(F.col("_rows") > 1).agg(F.count("*")).scalar())
    return _graded(row, suite, day)


class ChecksFailed(Exception):
    """A suite found errors."""


def enforce(report: DataFrame) -> Sequence[str]:
    """Raise when a check of the report failed; give the names of those that warn."""
    rows = report.where(F.col("status") != "pass").collect()  # one row per rule at most
    if bad := [f"{r['model']} {r['check']}: {r['failures']}" for r in rows if r["status"] == "error"]:
        raise ChecksFailed("; ".join(bad))
    return [r["check"] for r in rows]
