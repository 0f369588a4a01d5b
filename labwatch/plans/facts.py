"""Panel rows prepared for the matrices, and their pre-aggregated form.

The published tables group samples by week, place, age and kit and count
positives and negatives per pathogen. Unpivoting the 12 pathogens first would
multiply the rows by 12 ahead of every exchange; counting them side by side
gives the same numbers from one row per sample. ``facts`` adds those counters
to the panel. ``cube`` sums them over the keys the tables use, and since it
has the same columns, each table can be built from either: a single table
straight from the facts, the whole catalogue from cubes that one pass writes.

Distinct samples add up as well: ``week_sample`` and ``month_sample`` are 1 in
one of the rows that a sample has in a region and week or month, so their sums
over any coarser key are exact distinct counts. Samples leave the collapse
dealt by their key, and finding those rows needs no more than that.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labwatch.functions.dates import as_date
from labwatch.functions.mapping import or_label
from labwatch.functions.metrics import is_negative, is_positive
from labwatch.functions.text import normalize_text
from labwatch.operators.filters import is_tested
from labwatch.operators.joins import attach_band, attach_epiweek
from labwatch.vocab import ALL_REPORTED_KITS, NOT_REPORTED, PATHOGENS, RESULT_COLUMNS

FIRST_WEEK = "2022-01-01"

PLACE = ["location", "location_ibge_code", "lat", "long"]
KEYS = ["epiweek_enddate", "epiweek_number", "month", "quarter", "test_kit", "region", "state", "state_code", "age_group"]
CITY_KEYS = ["epiweek_enddate", "test_kit", "state", "state_code", *PLACE]
LAB_KEYS = ["lab_id", "test_kit"]
REGISTER_KEYS = ["epiweek_enddate", "region", "state"]
COUNTERS = [f"{p}_{side}" for p in PATHOGENS for side in ("pos", "neg")]
SAMPLES = ["week_sample", "month_sample"]
MASK, SET = "_mask", "cube_set"


def has_tested(pathogen: str) -> Column:
    return F.col(f"{pathogen}_tested")


def _tested() -> list[Column]:
    return [F.coalesce(is_tested(f"{p}_test_result"), F.lit(False)).alias(f"{p}_tested") for p in PATHOGENS]


def _counters() -> list[Column]:
    out = []
    for p in PATHOGENS:
        result = F.col(f"{p}_test_result")
        out += [is_positive(result).alias(f"{p}_pos"), is_negative(result).alias(f"{p}_neg")]
    return out


def rows(panel: DataFrame, as_of: str | date) -> DataFrame:
    """Samples of closed weeks since 2022 with missing places and ages labelled."""
    kept = panel.where((F.col("epiweek_enddate") < as_date(as_of)) & (F.col("epiweek_enddate") > as_date(FIRST_WEEK)))
    labelled = ["location", "state", "state_code", "region", "country", "age_group"]
    plain = [
        "sample_id", "test_kit", "epiweek_enddate", "date_testing", "month", "epiweek_number", "lab_id",
        "location_ibge_code", "lat", "long", *RESULT_COLUMNS,
    ]
    return kept.select(*plain, *[or_label(F.col(c)).alias(c) for c in labelled])


def counted_in_volumes() -> Column:
    return F.col("test_kit").isin(list(ALL_REPORTED_KITS)) & (F.col("region") != NOT_REPORTED) & F.col("sample_id").isNotNull()


def mark_samples(df: DataFrame) -> DataFrame:
    """``week_sample`` and ``month_sample`` for samples with a reported kit and region; other rows have 0.

    In a sample's rows by region and day, those of one region and week, or
    month, stand together; the first of them is marked.
    """
    order = Window.partitionBy("sample_id").orderBy("_counted", "region", "date_testing")
    seen = {c: F.lag(c).over(order) for c in ("_counted", "region", "epiweek_enddate", "month")}
    df = df.withColumn("_counted", F.coalesce(counted_in_volumes(), F.lit(False))).withColumns({f"_last_{c}": v for c, v in seen.items()})
    fresh = ~F.coalesce(F.col("_last__counted"), F.lit(False)) | (F.col("_last_region") != F.col("region"))

    def first_in(bucket: str) -> Column:
        return (F.col("_counted") & (fresh | (F.col(f"_last_{bucket}") != F.col(bucket)))).cast("int")

    marked = df.withColumns({"week_sample": first_in("epiweek_enddate"), "month_sample": first_in("month")})
    return marked.drop("_counted", *[f"_last_{c}" for c in seen])


def facts(panel: DataFrame, as_of: str | date) -> DataFrame:
    return mark_samples(rows(panel, as_of)).select(
        "*", F.trunc("date_testing", "quarter").alias("quarter"), *_tested(), *_counters()
    )


def register_rows(register: DataFrame, macroregions: DataFrame, municipalities: DataFrame, age_groups: DataFrame, as_of: str | date) -> DataFrame:
    """Register samples by week of first symptoms, with the region of their state and the code of their city."""
    regions = macroregions.select(normalize_text(F.col("state_name")).alias("_state"), "region").distinct()
    cities = municipalities.select(
        F.col("NM_MUN_NORM").alias("_city"), F.col("NM_UF_NORM").alias("_city_state"), F.col("CD_MUN").alias("location_ibge_code")
    )
    df = attach_epiweek(register, "date_pri_sin")
    df = df.where((F.col("epiweek_enddate") < as_date(as_of)) & (F.col("epiweek_enddate") >= as_date(FIRST_WEEK)))
    df = df.join(regions, df["state"] == regions["_state"], "left")
    df = df.join(cities, (df["location"] == cities["_city"]) & (df["state"] == cities["_city_state"]), "left")
    df = attach_band(df, age_groups)
    return df.select(
        "sample_id", "test_kit", "epiweek_enddate", "epiweek_number", "region", "state",
        or_label(F.col("location")).alias("location"), "location_ibge_code",
        or_label(F.col("age_group")).alias("age_group"), *RESULT_COLUMNS,
    )


def register_facts(register: DataFrame, macroregions: DataFrame, municipalities: DataFrame, age_groups: DataFrame, as_of: str | date) -> DataFrame:
    base = register_rows(register, macroregions, municipalities, age_groups, as_of)
    return base.select("*", *_tested(), *_counters())


def _mask() -> Column:
    """The set of tested pathogens as one number."""
    return reduce(add, [F.when(has_tested(p), 1 << i).otherwise(0) for i, p in enumerate(PATHOGENS)])


def _flags() -> list[Column]:
    return [(F.col(MASK).bitwiseAND(F.lit(1 << i)) != 0).alias(f"{p}_tested") for i, p in enumerate(PATHOGENS)]


def cube(facts_df: DataFrame, keys: list[str]) -> DataFrame:
    """Counters summed over the keys and the set of tested pathogens."""
    summed = facts_df.groupBy(*keys, _mask().alias(MASK)).agg(*[F.sum(c).alias(c) for c in COUNTERS])
    return summed.select(*keys, *_flags(), *COUNTERS)


def cubes(facts_df: DataFrame, sets: Mapping[str, Sequence[str]]) -> DataFrame:
    """Several cubes in one pass over the facts, told apart by the column ``cube_set``."""
    keyed = {name: [*keys, MASK] for name, keys in sets.items()}
    columns = list(dict.fromkeys(c for keys in keyed.values() for c in keys))
    # Spark's number of a grouping set has a bit for each column that the set leaves out, the first column's the highest
    number = {name: sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in keys) for name, keys in keyed.items()}
    summed = facts_df.withColumn(MASK, _mask()).groupingSets([[F.col(c) for c in keys] for keys in keyed.values()], *columns).agg(
        F.grouping_id().alias(SET), *[F.sum(c).alias(c) for c in (*COUNTERS, *SAMPLES)]
    )
    named = reduce(lambda e, n: e.when(F.col(SET) == number[n], n), keyed, F)
    return summed.withColumn(SET, named)


def one_cube(written: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """One of the cubes of a written pass."""
    return written.where(F.col(SET) == name).select(*keys, *_flags(), *COUNTERS, *SAMPLES)
