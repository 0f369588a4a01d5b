"""Repair of the headers of the one laboratory whose files change layout."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labwatch import labs_vocab as lv
from labwatch.functions.convert import to_mixed_date

RESULT = "Resultado"
_NAMED_VALUE = r"^([\w\d]+):\s*(.*)"


def rename_aliases(df: DataFrame, wanted: str, aliases: Sequence[str]) -> DataFrame:
    """Rename the misspelt column unless the right one exists."""
    if wanted in df.columns:
        return df
    return df.withColumnsRenamed({a: wanted for a in aliases if a in df.columns})


def recover_from_values(df: DataFrame, prefix: str = RESULT) -> DataFrame:
    """Columns that all came as ``Resultado``: the blank ones go, and one whose first value reads
    ``NAME: value`` takes that name and loses it in its values.

    One aggregate over the file looks at all these columns; the driver sees
    one row with one value per column.
    """
    suspects = [c for c in df.columns if c.startswith(prefix)]
    if not suspects:
        return df
    position = F.col("_position")
    looks = []
    for i, c in enumerate(suspects):
        value = F.col(f"`{c}`")
        looks.append(F.min_by(value, F.when(value.isNotNull(), position)).alias(f"first_{i}"))
        looks.append(F.max(F.when(F.trim(value) != "", 1).otherwise(0)).alias(f"any_{i}"))
    seen = df.withColumn("_position", F.monotonically_increasing_id()).agg(*looks).first()
    for i, c in enumerate(suspects):
        if not seen[f"any_{i}"]:
            df = df.drop(c)
            continue
        match = re.match(_NAMED_VALUE, seen[f"first_{i}"], re.UNICODE)
        if match:
            bare = F.trim(F.regexp_replace(F.coalesce(F.col(f"`{c}`"), F.lit("")), r"(?U)^[\w\d]+:\s*", ""))
            df = df.withColumn(c, bare).withColumnRenamed(c, match.group(1))
    left = [c for c in df.columns if c.startswith(prefix)]
    return df.withColumnRenamed(left[0], prefix) if len(left) == 1 else df


def apply_layout(df: DataFrame, marker: str, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns of a layout that is told by one of them."""
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns}) if marker in df.columns else df


def require(df: DataFrame, required: Sequence[str], optional: Sequence[str]) -> DataFrame:
    """Fail without the required columns, add the missing optional ones as NULL."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    return df.withColumns({c: F.lit(None).cast("string") for c in optional if c not in df.columns})


def repair_hlagyn(df: DataFrame) -> DataFrame:
    df = rename_aliases(df, "Métodologia", lv.HLAGYN_METHOD_ALIASES)
    df = rename_aliases(df, "Cidade", lv.HLAGYN_CITY_ALIASES)
    df = rename_aliases(df, "UF", lv.HLAGYN_STATE_ALIASES)
    df = recover_from_values(df)
    df = apply_layout(df, "VIRUS_HRSV", lv.HLAGYN_PANEL4_HEADERS)
    return require(df, lv.HLAGYN_COMMON_HEADERS, list(lv.HLAGYN_RESULT_HEADERS))


def normalize_dates(df: DataFrame, column: str, patterns: Sequence[str], out: str) -> DataFrame:
    """Rewrite a text date to one pattern; text that fits none becomes NULL."""
    return df.withColumn(column, F.date_format(to_mixed_date(F.col(f"`{column}`"), *patterns), out))


DAY_FIRST, MONTH_FIRST = "d/M/yyyy", "M/d/yyyy"


def day_first_files(df: DataFrame, columns: Sequence[str], by: str = "file_name") -> list[str]:
    """Files whose dates can only be read with the day first, from the ranges of the first two numbers.

    One aggregate over all deliveries; the driver sees a row for each file
    that is not plainly month first. A file in which both numbers exceed
    twelve mixes the orders and is refused.
    """
    part = lambda c, i: F.regexp_extract(F.col(f"`{c}`"), r"^\s*([0-9]+)[-/]([0-9]+)[-/][0-9]+", i).try_cast("int")
    highest = lambda i: F.max(F.greatest(*[part(c, i) for c in columns], F.lit(0)))
    found = df.groupBy(by).agg(highest(1).alias("first"), highest(2).alias("second")).where(F.col("first") > 12).collect()
    if mixed := [r[by] for r in found if r["second"] > 12]:
        raise ValueError(f"days and months change places within {mixed}")
    return [r[by] for r in found]


def month_first(df: DataFrame, columns: Sequence[str], order: str | None = None, by: str = "file_name") -> DataFrame:
    """Dates written month first, whatever order each delivery has them in.

    Without ``order`` each file's own is found; files that fit both are taken
    as month first. ``order`` (``d/M/yyyy`` or ``M/d/yyyy``) holds for all rows.
    """
    if order is None:
        turned = F.coalesce(F.col(by).isin(day_first_files(df, columns, by)), F.lit(False))
    else:
        turned = F.lit(order == DAY_FIRST)
    fixed = {c: F.when(turned, F.date_format(to_mixed_date(F.col(f"`{c}`"), DAY_FIRST), MONTH_FIRST)).otherwise(F.col(f"`{c}`")) for c in columns}
    return df.withColumns(fixed)


def prepare(lab_id: str, df: DataFrame, date_order: str | None = None) -> DataFrame:
    """What a laboratory's rows need between the file and its plan. ``date_order`` overrides what the files show."""
    if lab_id == "HLAGYN":
        return repair_hlagyn(df)
    if lab_id == "EINSTEIN":
        return normalize_dates(df, "dh_coleta", ["d/M/yyyy", "yyyy-M-d"], "dd/MM/yyyy")
    if lab_id == "SABIN":
        return month_first(df, ["DataAtendimento", "DataNascimento"], date_order)
    if lab_id == "HPARDINI":
        return normalize_dates(df, "DATACOLETA", ["M/d/yyyy", "yyyy-M-d", "d/M/yyyy"], "yyyy-MM-dd")
    return df
