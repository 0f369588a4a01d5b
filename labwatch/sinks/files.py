"""Delimited exports, the catalogue of tables and the published releases."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labwatch.operators.windows import sort_like_postgres


def write_delimited(df: DataFrame, path: str, sep: str = ",", one_file: bool = False, encoding: str = "UTF-8", ordered: bool = False) -> None:
    """Header and rows. ``one_file`` is for published tables, whose size the calendar bounds.

    ``ordered`` keeps the order of the rows; without it the table is computed
    in parallel before its rows meet in one file.
    """
    out = df.repartition(1) if one_file and not ordered else df.coalesce(1) if one_file else df
    writer = out.write.mode("overwrite").options(sep=sep, header=True, emptyValue="", escape='"', encoding=encoding)
    writer.options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def write_tsv(df: DataFrame, path: str, one_file: bool = False) -> None:
    write_delimited(df, path, "\t", one_file)


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


#: Tables exported at a time, and the scheduler pool of their jobs.
THREADS, POOL = 8, "exports"
T, R = TypeVar("T"), TypeVar("R")


def at_once(spark: SparkSession, run: Callable[[T], R], items: Iterable[T], threads: int = THREADS, pool: str | None = POOL) -> list[R]:
    """Jobs of several small tables side by side: the last tasks of one leave cores to the next.

    With ``spark.scheduler.mode`` FAIR the jobs share ``pool``, so a long one
    does not hold up the others. The first error is raised when all have ended.
    """

    def one(item: T) -> R:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", pool)
        return run(item)

    with ThreadPoolExecutor(threads) as workers:
        return [f.result() for f in [workers.submit(inheritable_thread_target(spark)(one), item) for item in items]]


def export_catalogue(
    tables: Mapping[str, DataFrame], folder: str, file_names: Mapping[str, str] | None = None,
    orders: Mapping[str, Sequence[tuple[str, str]]] | None = None, threads: int = THREADS,
) -> list[str]:
    """Every table as sorted text CSV under its file name, several at a time."""

    def export(name: str) -> str:
        df, order = tables[name], (orders or {}).get(name)
        out = sort_like_postgres(df, *order) if order else df
        path = f"{folder}/{(file_names or {}).get(name, name)}.csv"
        write_delimited(as_text(out), path, one_file=True, ordered=bool(order))
        return path

    return at_once(next(iter(tables.values())).sparkSession, export, tables, threads) if tables else []


def epi_week_text(day: datetime) -> str:
    """``SE07.2026``: number and year of the day's epidemiological week."""
    start = day - timedelta(days=(day.weekday() + 1) % 7)
    year = (start + timedelta(days=3)).year
    january_4 = datetime(year, 1, 4)
    first = january_4 - timedelta(days=(january_4.weekday() + 1) % 7)
    return f"SE{(start.date() - first.date()).days // 7 + 1:02d}.{year}"


def release_name(now: datetime, topic: str, previous: Sequence[str] = ()) -> str:
    """Time, topic, last closed week and version; the version follows the highest one of that week."""
    week = epi_week_text(now - timedelta(days=6))
    of_week = re.compile(rf"_{re.escape(week)}_V(\d+)$", re.IGNORECASE)
    versions = [int(m[1]) for m in map(of_week.search, filter(None, previous)) if m]
    return f"{now:%Y-%m-%d_%Hh%M}_{topic}_{week}_V{max(versions, default=0) + 1}"


def read_written(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """Text columns of a table that ``write_delimited`` wrote, quotes, backslashes, line ends and outer blanks included.

    A file holds nothing for empty text as for NULL; both are read as NULL.
    """
    return spark.read.csv(path, sep=sep, encoding=encoding, header=True, inferSchema=False, quote='"', escape='"', multiLine=True, emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def public_names(names: Sequence[str]) -> list[str]:
    """Only tables whose file name starts with a number are public."""
    return [n for n in names if re.match(r"\d+", n)]


def publish(
    tables: Mapping[str, DataFrame], root: str, public_root: str, release: str, file_names: Mapping[str, str],
    orders: Mapping[str, Sequence[tuple[str, str]]] | None = None,
) -> None:
    """Release folder and ``current``, and the public tables of the week in their own root.

    Each table is computed once, into the release; the other copies read that.
    """
    export_catalogue(tables, f"{root}/{release}/matrices/csv", file_names, orders)
    week = re.search(r"SE\d+\.\d+", release).group()
    public = set(public_names([file_names[n] for n in tables]))

    def copy_of(name: str) -> None:
        file = file_names[name]
        copy = read_written(tables[name].sparkSession, f"{root}/{release}/matrices/csv/{file}.csv")
        targets = [f"{root}/current/matrices/csv"]
        if file in public:
            targets += [f"{public_root}/{week}/matrices/csv", f"{public_root}/current/matrices/csv"]
        for target in targets:
            write_delimited(copy, f"{target}/{file}.csv", one_file=True, ordered=True)

    if tables:
        at_once(next(iter(tables.values())).sparkSession, copy_of, tables)
