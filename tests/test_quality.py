from datetime import date

from pyspark.sql import functions as F

from labwatch import vocab
from labwatch.operators import joins, quality

from .helpers import frame, tuples

R = vocab.RESULT_COLUMNS


def wide(spark, kind, *rows):
    """Rows as (kit, day, {pathogen: result}); other pathogens hold the empty value."""
    empty = "NT" if kind == "string" else -1
    full = [(kit, day, *[given.get(p, empty) for p in vocab.PATHOGENS]) for kit, day, given in rows]
    return frame(spark, "test_kit string, date_testing date, " + ", ".join(f"{c} {kind}" for c in R), *full)


D = date(2026, 2, 1)


def test_results_present(spark):
    df = wide(spark, "string", ("a", D, {}), ("b", D, {"SC2": "Neg"}))
    assert tuples(quality.no_result(df), "test_kit") == [("a",)]
    codes = wide(spark, "int", ("none", D, {}), ("one", D, {"SC2": 1}), ("two neg", D, {"SC2": 0, "VSR": 0}), ("bad", D, {"SC2": -2}))
    assert tuples(quality.no_result(codes, -1), "test_kit") == [("none",)]
    assert tuples(quality.not_exactly_one_result(codes), "test_kit") == [("bad",), ("none",)]


def test_kits(spark):
    df = wide(
        spark, "string", ("covid_pcr", D, {"SC2": "Pos"}), ("covid_pcr", D, {"SC2": "Pos", "VSR": "Neg"}), ("flu_pcr", D, {"FLUA": "Neg"}),
        ("flu_pcr", D, {"FLUA": "Neg", "FLUB": None}), ("test_23", D, {"SC2": "Pos"}), (None, D, {}),
    )
    assert tuples(quality.kit_mismatches(df), "test_kit") == [("covid_pcr",), ("flu_pcr",), ("test_23",), (None,)]


def test_freshness(spark):
    df = wide(spark, "string", ("k", date(2026, 2, 1), {"SC2": "Pos"}), ("k", date(2026, 2, 9), {"VSR": "Neg"}))
    assert tuples(quality.stale_pathogens(df, "2026-02-10"), "pathogen") == [("SC2",)]
    assert quality.stale_pathogens(df, "2026-02-05").count() == 0


def test_groups_and_shares(spark):
    df = frame(spark, "a string, b int", ("x", 1), ("x", 1), ("y", None), ("y", None), ("z", 2))
    assert quality.repeated_groups(df, ["a", "b"], 1).first().repeated == 2
    assert quality.repeated_groups(df, ["a", "b"], 2).count() == 0
    assert quality.unique_share(df, ["a", "b"]).first().share == 0.6
    assert quality.unique_share_outside(df, ["a", "b"], 0.5, 1.0).count() == 0
    assert quality.unique_share_outside(df.limit(0), ["a", "b"], 0.5, 1.0).count() == 0
    assert tuples(quality.repetitions_outside(df, "a", 2, 2)) == [("z", 1)]
    assert tuples(quality.duplicates(df, "b")) == [(1, 2)]
    assert quality.fewer_rows_than(df, 5).count() == 0 and quality.fewer_rows_than(df, 6).count() == 1


def test_values(spark):
    df = frame(spark, "s string, n int", ("ACRE", 5), ("acre", None), (None, 200))
    assert quality.accepted_states(df, "s").count() == 1
    assert quality.outside_range(df, "n", 0, 100).count() == 1
    assert quality.nulls(df, "s").count() == 1
    assert quality.forbidden(df, "s", ["ACRE"]).count() == 1
    assert quality.violates(df, F.col("n") > 1).count() == 1
    assert quality.not_null_share_below(df, "n", 0.7).count() == 1 and quality.not_null_share_below(df, "n", 0.6).count() == 0
    assert quality.missing_columns(df, ["s", "zz"]) == ["zz"]


def test_between_frames(spark):
    child, parent = frame(spark, "k int", (1,), (2,), (None,)), frame(spark, "id int", (1,))
    assert tuples(quality.orphans(child, "k", parent, "id")) == [(2,)]
    assert quality.unequal_rows(child, parent).count() == 1 and quality.unequal_rows(child, child).count() == 0
    samples = frame(spark, "qty_original_lines bigint", (2,), (3,))
    lines = frame(spark, "x int", *[(i,) for i in range(5)])
    assert quality.lost_lines(samples, lines).count() == 0
    assert quality.lost_lines(samples, lines.limit(4)).first().diff_qty_lines == 1


def test_weekly_rows(spark):
    df = frame(spark, "date_testing date", (date(2026, 2, 2),))
    bad = quality.weekly_rows_outside(df, joins.calendar(spark), "2026-02-15", 1, 5)
    assert {r.test_count for r in bad.collect()} == {0} and bad.count() == 4


def test_report(spark):
    df = frame(spark, "a int", (None,), (1,), (None,))
    got = quality.report(
        [
            quality.Check("nulls", "m", quality.nulls(df, "a"), warn_above=0, error_above=10),
            quality.Check("nulls strict", "m", quality.nulls(df, "a")),
            quality.Check("range", "m", quality.outside_range(df, "a", 0, 5)),
        ]
    )
    assert set(tuples(got)) == {("nulls", "m", 2, "warn"), ("nulls strict", "m", 2, "error"), ("range", "m", 0, "pass")}
