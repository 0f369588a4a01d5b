"""Dimension lookups and joins.

A dimension given as a Python mapping is small by definition and becomes a
literal-map expression: no join, and column pruning drops it from results
that do not read it. A dimension given as a DataFrame is joined by equality
without hints, so Catalyst broadcasts it only while its size estimate stays
under ``spark.sql.autoBroadcastJoinThreshold`` and sorts and merges beyond.
Range conditions on whole numbers or days are rewritten to equality, since a
range join could only run as a nested loop over a broadcast side of any size.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labwatch import vocab
from labwatch.functions import dates
from labwatch.functions.mapping import first_of, lookup, region_label
from labwatch.functions.text import normalize_text
from labwatch.session import checkpoint_dir
from labwatch.sinks.tables import as_table


def literal_table(spark: SparkSession, columns: list[str], rows: list[tuple]) -> DataFrame:
    """Small constant table planned as a local relation, so that its true size is known to the planner."""

    def lit(v: object) -> str:
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return str(v)

    body = ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(f'`{c}`' for c in columns)})")


@dataclass
class Dimensions:
    """Lookup tables of the panel. Geography is supplied by the user, the others have defaults.

    municipalities: CD_MUN, CD_UF, SIGLA_UF, NM_UF, NM_UF_NORM, NM_MUN, NM_MUN_NORM, REGIAO, lat, long
    macroregions: CO_UF, ADM2_PCODE, CO_MACSAUD, DS_NOMEPAD_macsaud, DS_UF_SIGLA, Populacao, state_name, region
    age_groups: (label, lowest, highest) or columns age_group, min_age, max_age
    test_methods: kit -> method or columns test_kit, test_method
    fix_state: spelling -> state or columns source_state, target_state
    fix_location: (location, state) -> location or columns source_location, source_state, target_location
    """

    municipalities: DataFrame
    macroregions: DataFrame
    age_groups: Sequence[tuple[str, int, int]] | DataFrame = field(default_factory=lambda: vocab.AGE_BANDS)
    test_methods: Mapping[str, str] | DataFrame = field(default_factory=lambda: vocab.TEST_METHODS)
    fix_state: Mapping[str, str] | DataFrame = field(default_factory=lambda: vocab.STATE_FIXES)
    fix_location: Mapping[tuple[str, str], str] | DataFrame = field(default_factory=lambda: vocab.LOCATION_FIXES)

    @cached_property
    def places(self) -> DataFrame:
        """Municipalities with their health region, written once to the shared folder.

        A joined frame has no more than a guess for its size, the product of
        its sides, and would draw the samples into an exchange by city. Of a
        written one the planner knows the true size: it broadcasts one below
        its threshold, and beyond it the largest city is split by AQE.
        """
        spark = self.municipalities.sparkSession
        return as_table(geography(self.municipalities, self.macroregions), f"{checkpoint_dir(spark)}/dimensions/{uuid.uuid4().hex}")


def read_dimension(spark: SparkSession, path: str) -> DataFrame:
    """CSV dimension. Headers and values may carry blanks after the comma."""
    df = spark.read.csv(path, header=True, inferSchema=False, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    return df.toDF(*[c.strip() for c in df.columns])


def attach_method(df: DataFrame, methods: Mapping[str, str] | DataFrame) -> DataFrame:
    if isinstance(methods, DataFrame):
        return df.join(methods.select("test_kit", "test_method"), "test_kit", "left")
    return df.withColumn("test_method", lookup(F.col("test_kit"), methods))


def attach_band(
    df: DataFrame, bands: Sequence[tuple[str, int, int]] | DataFrame, value: str = "age", label: str = "age_group"
) -> DataFrame:
    """Band holding a whole number, both ends included.

    A table of bands lists the numbers of each band and is joined by equality.
    """
    if not isinstance(bands, DataFrame):
        return df.withColumn(label, first_of(*[(F.col(value).between(lo, hi), F.lit(name)) for name, lo, hi in bands]))
    listed = bands.select(
        F.col(label), F.explode(F.sequence(F.col("min_age").cast("int"), F.col("max_age").cast("int"))).alias("_value")
    )
    return df.join(listed, df[value].cast("int") == listed["_value"], "left").drop("_value")


def attach_epiweek(df: DataFrame, day: str = "date_testing") -> DataFrame:
    """Week end, week number and month of a day, computed rather than looked up."""
    d = F.col(day)
    return df.withColumns(
        {
            "epiweek_enddate": dates.within_calendar(d, dates.week_end(d)),
            "epiweek_number": dates.within_calendar(d, dates.epi_week(d)),
            "month": dates.year_month(d),
        }
    )


def attach_calendar(df: DataFrame, weeks: DataFrame, day: str) -> DataFrame:
    """Week of a day from a calendar table with ``start_date`` Sundays: equality on the computed Sunday."""
    return df.join(weeks, dates.week_start(F.col(day)) == weeks["start_date"], "left")


_SEPARATOR = "\u0001"


def fix_places(
    df: DataFrame, fix_state: Mapping[str, str] | DataFrame, fix_location: Mapping[tuple[str, str], str] | DataFrame
) -> DataFrame:
    """Correct state names, then locations known under the original or else the corrected state."""
    others = [c for c in df.columns if c not in ("location", "state")]
    clean = df.select(*others, normalize_text(F.col("location")).alias("location"), normalize_text(F.col("state")).alias("state"))
    if isinstance(fix_state, DataFrame) or isinstance(fix_location, DataFrame):
        if not isinstance(fix_state, DataFrame):
            fix_state = df.sparkSession.createDataFrame(list(fix_state.items()), "source_state string, target_state string")
        if not isinstance(fix_location, DataFrame):
            rows = [(location, state, target) for (location, state), target in fix_location.items()]
            fix_location = df.sparkSession.createDataFrame(rows, "source_location string, source_state string, target_location string")
        return _fix_places_by_join(clean, others, fix_state, fix_location)
    location, state = F.col("location"), F.col("state")
    state_fix = lookup(state, {k.upper(): v for k, v in fix_state.items()})
    places = {f"{loc.upper()}{_SEPARATOR}{st.upper()}": target for (loc, st), target in fix_location.items()}

    def place(under: Column) -> Column:
        return lookup(F.concat(location, F.lit(_SEPARATOR), under), places)

    return clean.select(
        *others,
        F.coalesce(place(state), place(state_fix), location).alias("location"),
        F.coalesce(state_fix, state).alias("state"),
    )


def _fix_places_by_join(clean: DataFrame, others: list[str], fix_state: DataFrame, fix_location: DataFrame) -> DataFrame:
    """The location table is first widened by the spellings that lead to its states, so one join serves both ways."""
    states = fix_state.select(F.upper("source_state").alias("_state_key"), F.col("target_state").alias("_state"))
    direct = fix_location.select(
        F.upper("source_location").alias("_loc"), F.upper("source_state").alias("_st"), F.col("target_location").alias("_place"),
        F.lit(0).alias("_rank"),
    )
    through = direct.join(states, F.col("_st") == F.upper("_state")).select(
        "_loc", F.col("_state_key").alias("_st"), "_place", F.lit(1).alias("_rank")
    )
    places = direct.unionByName(through).groupBy("_loc", "_st").agg(F.min_by("_place", "_rank").alias("_place"))
    joined = clean.join(states, F.col("state") == F.col("_state_key"), "left").join(
        places, (F.col("location") == F.col("_loc")) & (F.col("state") == F.col("_st")), "left"
    )
    return joined.select(
        *others, F.coalesce("_place", "location").alias("location"), F.coalesce("_state", "state").alias("state")
    )


def geography(municipalities: DataFrame, macroregions: DataFrame) -> DataFrame:
    """Municipalities with their health region: the two dimensions meet before they meet the samples."""
    m = municipalities.select(
        "NM_MUN_NORM", "NM_UF_NORM", "NM_MUN", "NM_UF", "REGIAO", "SIGLA_UF", "CD_UF", "CD_MUN", "lat", "long"
    )
    r = macroregions.select("CO_UF", "ADM2_PCODE", "CO_MACSAUD", "DS_NOMEPAD_macsaud")
    code = F.concat(F.lit("BR"), F.col("CD_MUN").cast("string"))
    return m.join(r, (F.col("CD_UF") == F.col("CO_UF")) & (code == F.col("ADM2_PCODE")), "left")


def attach_geography(df: DataFrame, g: DataFrame) -> DataFrame:
    """Official names, codes, coordinates and health region of a (location, state) pair; ``g`` is a ``Dimensions``' places."""
    others = [c for c in df.columns if c not in ("location", "state")]
    joined = df.join(g, (df["location"] == g["NM_MUN_NORM"]) & (df["state"] == g["NM_UF_NORM"]), "left")
    return joined.select(
        *others,
        F.col("NM_MUN").alias("location"),
        F.col("NM_UF").alias("state"),
        F.lit("Brasil").alias("country"),
        region_label(F.col("REGIAO")).alias("region"),
        F.col("DS_NOMEPAD_macsaud").alias("macroregion"),
        F.col("CO_MACSAUD").alias("macroregion_code"),
        F.col("SIGLA_UF").alias("state_code"),
        F.col("CD_UF").alias("state_ibge_code"),
        F.col("CD_MUN").alias("location_ibge_code"),
        "lat",
        "long",
    )


def counts_per_week(df: DataFrame, weeks: DataFrame, day: str = "date_testing") -> DataFrame:
    """Rows per listed week, empty weeks included. Rows are counted per day first, days are then few."""
    per_day = df.groupBy(day).agg(F.count("*").alias("_n"))
    per_week = per_day.groupBy(dates.week_start(F.col(day)).alias("start_date")).agg(F.sum("_n").alias("_n"))
    return weeks.join(per_week, "start_date", "left").select(*weeks.columns, F.coalesce("_n", F.lit(0)).alias("test_count"))


def calendar(spark: SparkSession, first: str = vocab.CALENDAR_FIRST, last: str = vocab.CALENDAR_LAST) -> DataFrame:
    """Epidemiological calendar as a table: year, week_num, start_date, end_date."""
    days = spark.sql(
        f"SELECT explode(sequence(DATE'{first}', DATE'{last}', INTERVAL 7 DAYS)) AS start_date"
    )
    d = F.col("start_date")
    return days.select(
        dates.epi_year(d).alias("year"), dates.epi_week(d).alias("week_num"), "start_date", dates.week_end(d).alias("end_date")
    )
