"""Suites: one pass, graded the same by an aggregate and by what was seen while writing."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from conformance import frames
from conformance import testbed as tb
from labwatch.plans import suites
from labwatch.plans.labs import LABS
from labwatch.plans.suites import Rule, Suite

from .conftest import SF
from .helpers import frame, tuples

ROWS = "sample_id string, test_kit string, age int, date_testing date, SC2_test_result string"
SUITE = Suite(
    "M",
    (
        Rule("unique", "sample_id"), Rule("not_null", "sample_id"), Rule("accepted", "test_kit", ("a", "b")), Rule("range", "age", low=0, high=100),
        Rule("past", "date_testing"), suites.missing_most("age", 0, 1, 7), suites.warns("share", "age", low=0.9), suites.warns("fresh", values=("SC2",)),
        suites.warns("weeks", low=1, high=2),
    ),
)
AS_OF = date(2024, 3, 20)


def rows(spark, *more):
    day = date(2024, 3, 19)
    return frame(
        spark, ROWS, ("s1", "a", 5, day, "Pos"), ("s1", "a", 6, day, "NT"), ("s2", "c", 101, date(2024, 3, 21), "NT"), (None, None, None, day, "NT"),
        (None, "b", None, date(2024, 1, 1), "Neg"), *more,
    )


EXPECTED = {
    "unique_sample_id": (1, "error"), "not_null_sample_id": (2, "error"), "accepted_test_kit": (1, "error"), "range_age": (1, "error"), "past_date_testing": (1, "error"),
    "not_null_age_last_7_days": (1, "warn"), "share_age": (1, "warn"), "fresh": (0, "pass"), "weeks": (4, "warn"),
}


def test_grades(spark, tmp_path):
    read = lambda report: {c: (n, s) for c, m, n, s in tuples(report, "check", "model", "failures", "status")}
    assert read(suites.grade(rows(spark), SUITE, AS_OF)) == EXPECTED
    assert read(suites.write_checked(rows(spark), str(tmp_path / "t"), SUITE, "2024-03-20")) == EXPECTED
    assert spark.read.parquet(str(tmp_path / "t")).count() == 5
    empty = read(suites.grade(rows(spark).limit(0), SUITE, AS_OF))
    assert empty == read(suites.write_checked(rows(spark).limit(0), str(tmp_path / "e"), SUITE, AS_OF))
    assert {c for c, (n, _) in empty.items() if n} == {"weeks"}


def test_enforced(spark):
    with pytest.raises(suites.ChecksFailed, match="M unique_sample_id: 1"):
        suites.enforce(suites.grade(rows(spark), SUITE, AS_OF))
    soft = Suite("M", tuple(r for r in SUITE.rules if r.error is None))
    assert sorted(suites.enforce(suites.grade(rows(spark), soft, AS_OF))) == ["share_age", "weeks"]


@pytest.mark.parametrize("lab", ["DBMOL", "TARGET"])
def test_one_pass(spark, lab):
    """A suite adds no scan and no exchange of rows to the plan of its table."""
    df = LABS[lab].wide(tb.raw(spark, SF, lab))
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    own, graded = plan(df), plan(suites.grade(df, suites.SUITES[lab], tb.AS_OF))
    assert graded.count("Scan parquet") == own.count("Scan parquet")
    assert graded.count("hashpartitioning") == own.count("hashpartitioning") and graded.count("SinglePartition") == 1


def test_every_model_has_its_suite(spark):
    assert set(suites.SUITES) == {*LABS, "PANEL"}
    report = suites.grade(frames.full_panel(spark, SF), suites.SUITES["PANEL"], tb.AS_OF)
    assert report.where(F.col("status") == "pass").count() == 2
