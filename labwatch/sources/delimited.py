"""Delimited files, every column text.

Files split at ``spark.sql.files.maxPartitionBytes``, so a file of any size
is read in parallel; selecting columns prunes the parser's work. One job looks
at the lines of all files beforehand: it finds each file's header and whether
quoted text runs over line ends.
"""

from __future__ import annotations

import csv
import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# laboratory -> separator and encoding of its deliveries
FORMATS = {
    "DBMOL": (",", "UTF-8"),
    "EINSTEIN": (",", "UTF-8"),
    "FLEURY": ("\t", "ISO-8859-1"),
    "HILAB": (",", "UTF-8"),
    "HLAGYN": (",", "UTF-8"),
    "HPARDINI": (";", "ISO-8859-1"),
    "SABIN": (",", "UTF-8"),
    "TARGET": (",", "UTF-8"),
    "REGISTER": (";", "ISO-8859-1"),
    "ARCHIVE": ("\t", "UTF-8"),
}


_FILE, _EXTRA = "file name of the row", "fields beyond the header"
#: The raw line of a row that does not fit its header.
BROKEN = "broken_line"
#: The header is the first line with text among so many.
HEADER_LINES = 64


@dataclass(frozen=True)
class Layout:
    """Files with the same header. ``quoted`` ones hold text that runs over line ends and are not split."""

    names: tuple[str, ...]
    quoted: bool
    files: list[str]


def _literal(file: str) -> str:
    """A path from file metadata, without the escapes of a URI and safe from globbing."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(file))


def _names(header: str, sep: str) -> tuple[str, ...]:
    """Column names of a header line; an empty name and names that repeat get their place, as Spark's reader has it."""
    fields = next(csv.reader([header], delimiter=sep, quotechar='"'), [])
    times = Counter(f.lower() for f in fields)
    return tuple(f"_c{i}" if not f else f"{f}{i}" if times[f.lower()] > 1 else f for i, f in enumerate(fields))


def layouts(spark: SparkSession, paths: Sequence[str], sep: str, encoding: str, multi_line: bool = False) -> list[Layout]:
    """The layouts of all files, in one job, however many there are.

    In a session of its own each task reads one stretch of one file, so the
    lines at the start of a task that begins a file are that file's first
    ones, without sorting or counting lines. Of the other lines only those
    with an odd number of quotes go on: there a quoted text is left open.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.files.openCostInBytes", own.conf.get("spark.sql.files.maxPartitionBytes"))
    line = F.col("value").cast("binary")
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    lines = own.read.text(list(paths)).select(
        line.alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("n"),  # the line's number in its task
        (quotes % 2 == 1).alias("open"), (F.trim("value") != "").alias("text"),
    )
    first = (F.col("start") == 0) & (F.col("n") < HEADER_LINES) & F.col("text")
    seen = lines.where(first | F.col("open")).groupBy("file").agg(
        F.min_by(F.when(first, F.col("line")), F.when(first, F.col("n"))).alias("header"), F.max("open").alias("open")
    )
    found: dict[tuple[tuple[str, ...], bool], list[str]] = {}
    for r in seen.collect():  # one row for each file, as the driver's own listing has
        header = bytes(r["header"]).decode(encoding).removeprefix("﻿")
        found.setdefault((_names(header, sep), multi_line or r["open"]), []).append(_literal(r["file"]))
    return [Layout(names, quoted, sorted(files)) for (names, quoted), files in sorted(found.items())]


def _read(spark: SparkSession, layout: Layout, sep: str, encoding: str, last: str, **options: object) -> DataFrame:
    """Rows of one layout with the file's name and one more column, ``last``."""
    schema = StructType([StructField(c, StringType()) for c in (*layout.names, last)])
    reader = spark.read.options(sep=sep, encoding=encoding, header=True, inferSchema=False, quote='"', escape='"', multiLine=layout.quoted, **options)
    # the name comes as part of a URI, where a plus stands for itself
    name = F.url_decode(F.replace("_metadata.file_name", F.lit("+"), F.lit("%2B")))
    return reader.schema(schema).csv(list(layout.files)).withColumn(_FILE, name)


def stacked(frames: Sequence[DataFrame]) -> DataFrame:
    """Frames on top of each other by column name; absent columns are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_delimited(
    spark: SparkSession, path: str | Sequence[str], sep: str = ",", encoding: str = "UTF-8",
    columns: Sequence[str] | None = None, file_name: bool = True, multi_line: bool = False,
) -> DataFrame:
    """Text columns named by the header, the chosen ones only when given, and the name of the file.

    Files with different headers are read layout by layout and stacked by
    column name; absent columns are NULL. A row with more fields than its
    header, which is one line, fails the read; one with fewer has NULLs.
    Quoted text may run over line ends: files in which it does are not split,
    nor are any with ``multi_line``.
    """
    paths = [path] if isinstance(path, str) else list(path)
    found = layouts(spark, paths, sep, encoding, multi_line)
    if not found:
        raise ValueError(f"no line in {paths}")
    df = stacked([_read(spark, layout, sep, encoding, _EXTRA) for layout in found])
    wanted = [F.col(f"`{c}`") for c in (columns or [c for c in df.columns if c not in (_FILE, _EXTRA)])]
    checked = F.when(F.col(_EXTRA).isNotNull(), F.raise_error(F.concat(F.lit("more fields than the header has: "), F.col(_EXTRA)))).otherwise(F.lit(True))
    return df.where(checked).select(*wanted, *([F.col(_FILE).alias("file_name")] if file_name else []))


def read_apart(spark: SparkSession, layout: Layout, sep: str, encoding: str) -> DataFrame:
    """Rows of one layout, ``file_name``, and in ``broken_line`` the raw line of a row with more fields than the header.

    Write the frame before asking for the broken lines alone: Spark refuses to
    read nothing but them from the files.
    """
    rows = _read(spark, layout, sep, encoding, BROKEN, mode="PERMISSIVE", columnNameOfCorruptRecord=BROKEN, columnPruning=False)
    # Spark reports rows with too few fields as well; those are taken, with NULLs
    bare = F.regexp_replace(BROKEN, '"[^"]*"', "")
    surplus = F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) >= len(layout.names)
    return rows.select(*[f"`{c}`" for c in layout.names], F.col(_FILE).alias("file_name"), F.when(surplus, F.col(BROKEN)).alias(BROKEN))


def read_lab(spark: SparkSession, lab_id: str, path: str | Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    sep, encoding = FORMATS[lab_id]
    return read_delimited(spark, path, sep, encoding, columns)


def read_sheets(spark: SparkSession, paths: Sequence[str], sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """Sheets of one workbook, delivered as one file each, stacked by column name; absent columns are NULL."""
    return read_delimited(spark, paths, sep, encoding)
