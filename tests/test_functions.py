from datetime import date, timedelta

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from labwatch import vocab
from labwatch.functions import ages, convert, dates, keys, mapping, metrics, results, text
from labwatch.operators.joins import calendar

from .helpers import frame


def one(spark, schema, values, *columns):
    df = frame(spark, schema, *[(v,) if not isinstance(v, tuple) else v for v in values])
    return [tuple(r) if len(columns) > 1 else r[0] for r in df.select(*columns).collect()]


def test_normalize_text(spark):
    got = one(spark, "x string", ["  São Paulo ", "\tgoiânia\t", "Ñandú\\", None, ""], text.normalize_text(F.col("x")))
    assert got == ["SAO PAULO", "GOIANIA", "NANDU", None, ""]


def test_strip_and_squeeze(spark):
    assert one(spark, "x string", ["a-b_c d!"], text.strip_nonword(F.col("x"))) == ["ab_c d"]
    assert one(spark, "x string", ["INF A:  X.\tY"], text.squeeze(F.col("x"))) == ["INF A X Y"]


def test_key_skips_nulls_and_prefix_does_not(spark):
    df = frame(spark, "a string, b int", ("x", None), ("x", 1))
    a, b = [r[0] for r in df.select(keys.sample_key(F.col("a"), F.col("b"))).collect()]
    assert a == "9dd4e461268c8034f5c8564e155c67a6" and a != b
    assert one(spark, "x string", [None, "1"], keys.prefixed("H_", F.col("x"))) == [None, "H_1"]


def test_age_text(spark):
    got = one(spark, "x string", ["95", "95A10M", "11M10D", "30D", None, "idoso", "", "A"], ages.parse_age_text(F.col("x"), -1))
    assert got == [95, 95, 0, 0, None, -1, None, None]
    assert one(spark, "x string", ["idoso"], ages.parse_age_text(F.col("x"))) == [None]


def test_completed_years_on_leap_day(spark):
    df = frame(spark, "a date, b date", (date(2023, 2, 28), date(2000, 2, 29)), (date(2024, 2, 29), date(2000, 2, 29)), (date(2000, 1, 1), date(2001, 1, 1)))
    assert [r[0] for r in df.select(ages.completed_years(F.col("a"), F.col("b"))).collect()] == [22, 24, -1]


def test_clamp(spark):
    assert one(spark, "x int", [-1, 0, 120, 121, None], ages.clamp_age(F.col("x"))) == [None, 0, 120, None, None]
    assert one(spark, "x int", [-1, 121], ages.clamp_age(F.col("x"), high=None)) == [None, 121]


def test_numbers_and_dates_from_text(spark):
    assert one(spark, "x string", ["3.0", "3.6", "-2.5", "x", None], convert.to_rounded_int(F.col("x"))) == [3, 4, -3, None, None]
    assert one(spark, "x string", ["0012", "x"], convert.integer_text(F.col("x"))) == ["12", None]
    got = one(spark, "x string", ["2024-01-31 10:00", "31/1/2024", "31/02/2024", ""], convert.to_mixed_date(F.col("x"), "d/M/yyyy", "yyyy-M-d"))
    assert got == [date(2024, 1, 31), date(2024, 1, 31), None, None]


def test_thresholds(spark):
    got = one(spark, "x string", ["29.9", "30", "REAGENTE", "10,5", "7d", None], results.two_way(F.col("x"), 30.0))
    assert got == [0, 1, -2, None, None, -2]
    got = one(spark, "x string", ["8", "8.01", "10", "10.5", ">3"], results.three_way(F.col("x"), 8.0, 10.0))
    assert got == [0, -3, -3, 1, -2]


def test_labels_have_no_default(spark):
    assert one(spark, "x int", [1, 0, -1, -2, 9, None], results.result_label(F.col("x"))) == ["Pos", "Neg", "NT", None, None, None]


def test_maps(spark):
    assert one(spark, "x string", ["SP", "sp", None], mapping.state_name(F.col("x"))) == ["SAO PAULO", None, None]
    assert one(spark, "x string", ["SP", "??"], mapping.state_name(F.col("x"), "NOT REPORTED")) == ["SAO PAULO", "NOT REPORTED"]
    assert one(spark, "x string", ["fem", "Masc", "I", None], mapping.sex_by_prefix(F.col("x"))) == ["F", "M", None, None]
    assert one(spark, "x string", ["DB Mol", "SABIN"], mapping.lookup_keep(F.col("x"), vocab.LAB_ID_FIXES)) == ["DBMOL", "SABIN"]


def brute_week(d: date) -> tuple[int, int, date, date]:
    """Walk from the Sunday on or before 4 January, week by week."""
    sunday = d - timedelta(days=d.isoweekday() % 7)
    year = (sunday + timedelta(days=3)).year
    first = date(year, 1, 4)
    while first.isoweekday() != 7:
        first -= timedelta(days=1)
    n = 1
    while first < sunday:
        first, n = first + timedelta(days=7), n + 1
    return year, n, sunday, sunday + timedelta(days=6)


def test_epi_calendar_is_the_published_one(spark):
    rows = calendar(spark).orderBy("start_date").collect()
    assert len(rows) == 522
    assert (rows[0].start_date, rows[-1].end_date) == (date(2017, 12, 31), date(2028, 1, 1))
    for r in rows:
        assert (r.year, r.week_num, r.start_date, r.end_date) == brute_week(r.start_date)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.dates(date(2018, 1, 1), date(2027, 12, 31)), min_size=20, max_size=40))
def test_epi_week_of_any_day(spark, days):
    d = F.col("d")
    df = frame(spark, "d date", *[(x,) for x in days]).select("d", dates.epi_year(d), dates.epi_week(d), dates.week_start(d), dates.week_end(d))
    for row in df.collect():
        assert tuple(row)[1:] == brute_week(row[0])


def test_outside_the_calendar(spark):
    d = F.col("x")
    assert one(spark, "x date", [date(2017, 12, 30), date(2028, 1, 2)], dates.within_calendar(d, dates.epi_week(d))) == [None, None]


def test_week_formats(spark):
    d = F.col("x")
    got = one(spark, "x date", [date(2026, 2, 10)], dates.format_week(d, "SE{EPINUM}.{EPIYEAR} %Y-%m-%d", 2), dates.format_week(d), dates.week_label(dates.epi_week(d)), dates.quarter_label(d))
    assert got == [("SE06.2026 2026-02-14", "6", "SE06 - Fev", "2026 - 1º Trimestre")]


def test_rate_needs_fifty(spark):
    df = frame(spark, "p int, n int", (25, 24), (25, 25))
    assert [r[0] for r in df.select(metrics.positivity_rate(F.col("p"), F.col("n"))).collect()] == [None, 0.5]


def test_rounding(spark):
    assert one(spark, "x double", [0.5, 1.49, 2.5], metrics.half_up(F.col("x"))) == [1, 1, 3]
    assert one(spark, "x bigint", [1234567], metrics.thousands_dot(F.col("x"))) == ["1.234.567"]
    assert one(spark, "x int", [0], metrics.per_100k(F.lit(5), F.col("x"))) == [None]
