"""Epidemiological calendar: weeks run Sunday to Saturday, week 1 holds 4 January."""

from __future__ import annotations

import re
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from labwatch import vocab
from labwatch.functions.mapping import first_of


def week_start(d: Column) -> Column:
    return F.date_sub(d, F.dayofweek(d) - 1)


def week_end(d: Column) -> Column:
    return F.date_add(week_start(d), 6)


def epi_year(d: Column) -> Column:
    """Year holding most days of the week, that is its Wednesday's."""
    return F.year(F.date_add(week_start(d), 3))


def epi_week(d: Column) -> Column:
    first = week_start(F.make_date(epi_year(d), F.lit(1), F.lit(4)))
    return (F.datediff(week_start(d), first) / 7 + 1).cast("int")


def within_calendar(d: Column, value: Column) -> Column:
    """The calendar is finite: days outside it belong to no week."""
    return F.when(d.between(F.lit(vocab.CALENDAR_FIRST).cast("date"), F.lit(vocab.CALENDAR_LAST).cast("date")), value)


def month_label(week: Column) -> Column:
    """Portuguese month abbreviation that stands for a week number."""
    starts = vocab.MONTH_LABEL_STARTS
    return first_of(*[(week >= first, F.lit(label)) for first, label in reversed(starts)])


def week_label(week: Column) -> Column:
    """``SE07 - Fev``. A missing label leaves the text open-ended."""
    return F.concat(F.lit("SE"), F.lpad(week.cast("string"), 2, "0"), F.lit(" - "), F.coalesce(month_label(week), F.lit("")))


def year_month(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def quarter_label(d: Column) -> Column:
    return F.date_format(d, "yyyy - q'º Trimestre'")


def local_time(ts: Column, zone: str = vocab.LOCAL_TIME_ZONE) -> Column:
    """Wall-clock time in the laboratories' zone, as a zone-free timestamp."""
    return F.from_utc_timestamp(ts, zone).cast("timestamp_ntz")


_FIELDS = {"{EPINUM}", "{EPIYEAR}", "{EPISTART}", "{EPIEND}"}
# strftime directive -> Spark date pattern
_STRFTIME = {"%Y": "yyyy", "%y": "yy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss", "%j": "DDD"}


def format_week(d: Column, fmt: str = "{EPINUM}", zfill: int = 0, from_week_end: bool = True) -> Column:
    """Text of a week. Fields are ``{EPINUM} {EPIYEAR} {EPISTART} {EPIEND}``; ``%Y %m %d`` and the other
    numeric strftime directives read the last day of the week, or the day itself."""
    if "{EPINUM}" not in fmt:
        raise ValueError("the format must contain {EPINUM}")
    if zfill < 0:
        raise ValueError("zfill must not be negative")
    number = epi_week(d).cast("string")
    if zfill > 1:
        number = F.lpad(number, zfill, "0")
    anchor = week_end(d) if from_week_end else d
    parts = []
    for token in re.split(r"(\{EPI[A-Z]+\}|%[A-Za-z])", fmt):
        if token == "{EPINUM}":
            parts.append(number)
        elif token == "{EPIYEAR}":
            parts.append(epi_year(d).cast("string"))
        elif token == "{EPISTART}":
            parts.append(week_start(d).cast("string"))
        elif token == "{EPIEND}":
            parts.append(week_end(d).cast("string"))
        elif token in _STRFTIME:
            parts.append(F.date_format(anchor, _STRFTIME[token]))
        elif token.startswith("%"):
            raise ValueError(f"unsupported directive {token}")
        elif token:
            parts.append(F.lit(token))
    return F.concat(*parts)


def as_date(value: str | date | datetime) -> Column:
    """Literal day from text, a date or a datetime."""
    if isinstance(value, datetime):
        value = value.date()
    return F.lit(value.isoformat() if isinstance(value, date) else value).cast("date")
