"""The published tables, by name.

``build`` gives one table; ``build_all`` gives every table from shared,
checkpointed aggregates. Column names are those of the published files.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from datetime import date
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labwatch import vocab
from labwatch.functions.dates import as_date, epi_year, quarter_label, week_label
from labwatch.functions.metrics import per_100k, positivity_rate
from labwatch.operators.filters import latest, recent, routed
from labwatch.operators.joins import Dimensions
from labwatch.operators.reshape import calendar_values, complete_buckets, distinct_values, pivot_sum
from labwatch.operators.windows import running_total
from labwatch.plans import facts as fx
from labwatch.plans.facts import has_tested
from labwatch.session import checkpoint_dir, materialize
from labwatch.sinks.tables import as_table
from labwatch.vocab import NOT_REPORTED, PATHOGEN_LABELS, PATHOGENS, REGIONS


@dataclass(frozen=True)
class Source:
    """What the tables read.

    ``facts``, ``city_facts``, ``lab_facts`` and ``register`` are samples with
    counters or cubes of them.
    """

    facts: DataFrame
    city_facts: DataFrame
    lab_facts: DataFrame
    register: DataFrame | None
    macroregions: DataFrame
    as_of: str | date


@dataclass(frozen=True)
class Matrix:
    """One published table: how to build it and how its file is sorted."""

    build: Callable[[Source], DataFrame]
    order: Sequence[tuple[str, str]] = field(default_factory=tuple)
    file_name: str | None = None


def source(panel: DataFrame, register: DataFrame | None, dims: Dimensions, as_of: str | date) -> Source:
    f = fx.facts(panel, as_of)
    reg = None
    if register is not None:
        reg = fx.register_facts(register, dims.macroregions, dims.municipalities, dims.age_groups, as_of)
    return Source(f, f, f, reg, dims.macroregions, as_of)


_CUBES = {"facts": fx.KEYS, "city_facts": fx.CITY_KEYS, "lab_facts": fx.LAB_KEYS}


def shared(src: Source, sets: Sequence[str] = tuple(_CUBES)) -> Source:
    """The same source with its counters summed and written out once, in one pass over the samples.

    The cubes lie in a folder each, so that a table reads the columns it needs of its own.
    """
    path = f"{checkpoint_dir(src.facts.sparkSession)}/cubes/{uuid.uuid4().hex}"
    written = as_table(fx.cubes(src.facts, {name: _CUBES[name] for name in sets}), path, fx.SET)
    return replace(
        src,
        **{name: fx.one_cube(written, name, _CUBES[name]) for name in sets},
        register=None if src.register is None else materialize(fx.cube(src.register, fx.REGISTER_KEYS)),
    )


# -- pieces ------------------------------------------------------------------


def pos(p: str) -> Column:
    return F.sum(f"{p}_pos")


def neg(p: str) -> Column:
    return F.sum(f"{p}_neg")


def rate(p: str) -> Column:
    return positivity_rate(pos(p), neg(p))


def percent(p: str) -> Column:
    return rate(p) * 100


def count(c: Column) -> Column:
    return c.cast("int")


def kits(names: Sequence[str]) -> Column:
    return F.col("test_kit").isin(list(names))


def routes(*branches: tuple[str, Sequence[str]]) -> Column:
    """The first pathogen of the list that the sample was tested for decides with its own kits."""
    return routed([(has_tested(p), kits(names)) for p, names in branches])


def from_week(day: str) -> Column:
    return F.col("epiweek_enddate") >= as_date(day)


FOUR = ["FLUA", "FLUB", "SC2", "VSR"]
OTHERS = ["COVS", "ADENO", "BOCA", "RINO", "PARA", "ENTERO", "META", "BAC"]
PANEL20 = ["RINO", "ENTERO", "FLUA", "FLUB", "ADENO", "SC2", "COVS", "BOCA", "PARA", "META", "VSR", "BAC"]
PYRAMID = ["SC2", "FLUA", "FLUB", "VSR", "COVS", "ADENO", "BOCA", "RINO", "PARA", "ENTERO", "META", "BAC"]

FOUR_ROUTES = [
    ("SC2", vocab.SC2_ROUTED_KITS), ("FLUA", vocab.FLU_KITS), ("FLUB", vocab.FLU_KITS), ("VSR", vocab.VSR_KITS),
]
PANEL4_ROUTES = [(p, vocab.PANEL4_KITS) for p in ("SC2", "FLUA", "FLUB", "VSR")]
OTHER_ROUTES = [
    ("COVS", vocab.WIDE_KITS),
    ("ADENO", [*vocab.WIDE_KITS, "adeno_pcr"]),
    ("BOCA", ["test_14", "test_23", "test_24"]),
    ("RINO", vocab.WIDE_KITS),
    ("PARA", vocab.WIDE_KITS),
    ("ENTERO", vocab.WIDE_KITS),
    ("META", vocab.WIDE_KITS),
    ("BAC", ["test_21", "test_23", "test_24", "bac_pcr", "bac_antigen"]),
]
_LARGE_PANELS = ["test_21", "test_23", "test_24"]
PYRAMID_ROUTES = [
    (p, {"COVS": ["test_21", "test_24"], "BOCA": ["test_23", "test_24"]}.get(p, _LARGE_PANELS)) for p in PYRAMID
]

WEEK = "epiweek_enddate"


# -- weekly lines and bars ---------------------------------------------------


def rate_lines(pathogens: Sequence[str], condition: Callable[[], Column]) -> Callable:
    """Weekly positivity, one column per pathogen."""

    def build(src: Source) -> DataFrame:
        return (
            src.facts.where(condition())
            .groupBy(F.col(WEEK).alias("semana epidemiológica"))
            .agg(*[percent(p).alias(PATHOGEN_LABELS[p]) for p in pathogens])
        )

    return build


def count_bars(
    pathogens: Sequence[str], condition: Callable[[], Column], keys: Sequence[tuple[str, str]] = ((WEEK, "semana epidemiológica"),)
) -> Callable:
    """Positives, one column per pathogen."""

    def build(src: Source) -> DataFrame:
        return (
            src.facts.where(condition())
            .groupBy(*[F.col(c).alias(name) for c, name in keys])
            .agg(*[count(pos(p)).alias(PATHOGEN_LABELS[p]) for p in pathogens])
        )

    return build


def overall_line(src: Source) -> DataFrame:
    """All pathogens together: a sample counts once per conclusive result."""

    def everything(side: str) -> Column:
        return reduce(add, [F.sum(f"{p}_{side}") for p in PATHOGENS])

    return (
        src.facts.where(kits(vocab.ALL_REPORTED_KITS))
        .groupBy(F.col(WEEK).alias("semanas_epidemiologicas"))
        .agg(
            (positivity_rate(everything("pos"), everything("neg")) * 100).alias("Positividade (%)"),
            everything("pos").alias("Positivos"),
            everything("neg").alias("Negativos"),
        )
    )


def flat_rates(keys: Sequence[tuple[str, str]]) -> Callable:
    """One row per key and main pathogen with counts and rate. The pathogens are unpivoted after aggregation."""
    main = ["SC2", "FLUA", "FLUB", "VSR"]

    def build(src: Source) -> DataFrame:
        grouped = (
            src.facts.where(routes(*FOUR_ROUTES) & from_week("2022-01-01"))
            .groupBy(*[F.col(c).alias(name) for c, name in keys])
            .agg(*[F.sum(f"{p}_{side}").alias(f"{p}_{side}") for p in main for side in ("pos", "neg")])
        )
        measures = F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(p).alias("Patógeno"),
                        F.col(f"{p}_pos").alias("Testes Positivos"),
                        F.col(f"{p}_neg").alias("Testes Negativos"),
                        (F.col(f"{p}_pos") + F.col(f"{p}_neg")).alias("Total de Testes"),
                        (positivity_rate(F.col(f"{p}_pos"), F.col(f"{p}_neg")) * 100).alias("Taxa de Positividade (%)"),
                    )
                    for p in main
                ]
            )
        )
        return grouped.select(*[f"`{name}`" for _, name in keys], measures)

    return build


def annual_lines(pathogen: str, kit_names: Sequence[str]) -> Callable:
    """Week of the year by year, rates of 2022 to 2026."""
    years = [2022, 2023, 2024, 2025, 2026]

    def build(src: Source) -> DataFrame:
        per_year = (
            src.facts.where(has_tested(pathogen) & kits(kit_names))
            .groupBy(week_label(F.col("epiweek_number")).alias("label"), epi_year(F.col(WEEK)).alias("year"))
            .agg(percent(pathogen).alias("percent"))
        )
        return per_year.groupBy(F.col("label").alias("semana epidemiológica  (SE)")).agg(
            *[F.max(F.when(F.col("year") == y, F.col("percent"))).alias(str(y)) for y in years]
        )

    return build


def volume_bars(bucket: str, marks: str, name: str, start: Callable[[], Column]) -> Callable:
    """Distinct samples per region: the sum of their marks."""

    def build(src: Source) -> DataFrame:
        per_region = (
            src.facts.where(start() & kits(vocab.ALL_REPORTED_KITS) & (F.col("region") != NOT_REPORTED))
            .groupBy(bucket, "region")
            .agg(F.sum(marks).alias("n"))
        )
        wide = pivot_sum(per_region, [bucket], "region", F.col("n"), {r: r for r in REGIONS})
        return wide.withColumnRenamed(bucket, name)

    return build


# -- heat maps and pyramids --------------------------------------------------


def age_heat(pathogen: str, kit_names: Sequence[str], rate_name: str) -> Callable:
    def build(src: Source) -> DataFrame:
        return (
            src.facts.where((F.col("age_group") != NOT_REPORTED) & kits(kit_names) & from_week("2022-01-01"))
            .groupBy(F.col(WEEK).alias("Semana epidemiológica"), F.col("age_group").alias("Faixa etária"))
            .agg(
                percent(pathogen).alias(rate_name),
                count(pos(pathogen) + neg(pathogen)).alias("Total de testes realizados"),
                count(pos(pathogen)).alias("Total de positivos"),
                count(neg(pathogen)).alias("Total de negativos"),
            )
        )

    return build


GOOD_SHARE = 0.7
YEAR_DAYS = 381


def state_heat(src: Source) -> DataFrame:
    """SARS-CoV-2 rate per state and week with a grade of how complete each state's series is."""
    cells = (
        src.facts.where(kits(vocab.SC2_KITS) & from_week("2022-01-01"))
        .groupBy(WEEK, "state_code", "region")
        .agg(percent("SC2").alias("percent"), count(pos("SC2")).alias("pos"), count(neg("SC2")).alias("neg"))
    )
    in_year, filled = F.col(WEEK) >= F.col("year_start"), F.col("percent").isNotNull()
    series = Window.partitionBy("state_code")
    graded = (
        cells.withColumn("weeks", calendar_values(cells, WEEK))
        .withColumn("year_start", F.date_sub(F.array_max("weeks"), YEAR_DAYS))
        .withColumns(
            {
                "total": F.size("weeks"),
                "total_year": F.size(F.filter("weeks", lambda week: week >= F.col("year_start"))),
            }
        )
        .withColumns(
            {
                "filled": F.count(F.when(filled, 1)).over(series),
                # a state without a row in the year has no yearly count at all
                "in_year": F.when(
                    F.count(F.when(in_year, 1)).over(series) > 0, F.count(F.when(filled & in_year, 1)).over(series)
                ),
            }
        )
    )
    share = F.col("filled").cast("double") / F.col("total")
    share_year = F.col("in_year").cast("double") / F.col("total_year")
    good, good_year = share >= GOOD_SHARE, share_year >= GOOD_SHARE
    return graded.where((F.col("state_code") != NOT_REPORTED) & (F.col("region") != NOT_REPORTED)).select(
        F.col(WEEK).alias("semanas_epidemiologicas"),
        F.col("state_code").alias("UF"),
        F.col("region").alias("Região"),
        F.col("percent").alias("Positividade"),
        (F.col("pos") + F.col("neg")).alias("Total de testes realizados"),
        F.col("pos").alias("Total de positivos"),
        F.col("neg").alias("Total de negativos"),
        F.when(good, "Bom Histórico").otherwise("Ruim histórico").alias("Completude do histórico"),
        share.alias("Valor da completude do histórico"),
        F.when(good_year, "Bom 12 meses").otherwise("Ruim 12 meses").alias("Completude do ano"),
        share_year.alias("Valor da completude do ano"),
        F.when(good & good_year, "Alta qualidade")
        .when((share < GOOD_SHARE) & (share_year < GOOD_SHARE), "Baixa qualidade")
        .when(good & (share_year < GOOD_SHARE), "Apenas histórico")
        .otherwise("Apenas 12 meses")
        .alias("Completude final"),
        count(F.col("total")).alias("Total de semanas históricas"),
        count(F.col("filled")).alias("Semanas históricas preenchidas"),
        count(F.col("total_year")).alias("Total de semanas do ano"),
        count(F.col("in_year")).alias("Semanas do ano preenchidas"),
    )


def quarter_pyramid(src: Source) -> DataFrame:
    """Positives per quarter and age band; combinations without samples stay empty."""
    cells = (
        src.facts.where(
            kits(vocab.MULTIPLEX_KITS)
            & (F.col("age_group") != NOT_REPORTED)
            & (F.col("quarter") >= as_date("2022-01-01"))
            & (F.col("quarter") < F.trunc(as_date(src.as_of), "quarter"))
        )
        .groupBy(quarter_label(F.col("quarter")).alias("trimestre"), F.col("age_group").alias("faixas_etarias"))
        .agg(*[count(pos(p)).alias(PATHOGEN_LABELS[p]) for p in PYRAMID])
    )
    return complete_buckets(cells, ["faixas_etarias"], "trimestre", calendar_values(cells, "trimestre"))


# -- cumulative maps ---------------------------------------------------------

CAPITALS = {
    "location_ibge_code": "Location_ibge_code", "location": "Location", "state_code": "State_code", "state": "State",
    "lat": "Lat", "long": "Long", "cases": "Casos na última semana", "total": "Casos cumulativos",
}


def case_map(
    pathogen: str, start: str, kit_names: Sequence[str], place: Sequence[str], week_name: str, tested_only: bool = False,
    renames: dict[str, str] | None = None, code_as_state: bool = False,
) -> Callable:
    """Weekly and cumulative positives per place and 100 000 people.

    A place with a case appears in every week from its first case on, and a
    place without cases never does. ``place`` lists the place columns of the
    result; name, code and coordinates of a place determine each other.
    """
    names = {"cases": "Casos da semana", "total": "Casos acumulados", **(renames or {})}
    by_city = "location" in place

    def build(src: Source) -> DataFrame:
        base = (src.city_facts if by_city else src.facts).where(from_week(start))
        if code_as_state:
            base = base.withColumn("state", F.col("state_code"))
        chosen = base.where(kits(kit_names) & (F.col("state") != NOT_REPORTED))
        if tested_only:
            chosen = chosen.where(has_tested(pathogen))
        if by_city:
            chosen = chosen.where(F.col("location") != NOT_REPORTED)
        cells = chosen.groupBy(WEEK, *place).agg(pos(pathogen).alias("cases"))
        filled = complete_buckets(cells, place, WEEK, calendar_values(base, WEEK), fill=0)
        running = filled.withColumn("total", running_total("cases", place, WEEK)).where(F.col("total") > 0)
        full = running.join(
            population(src.macroregions, by_city), "location_ibge_code" if by_city else "state_code", "left"
        )
        return full.select(
            F.col(WEEK).alias(week_name),
            *[F.col(c).alias(names.get(c, c)) for c in place],
            F.col("people").alias("População"),
            count(F.col("cases")).alias(names["cases"]),
            count(F.col("total")).alias(names["total"]),
            per_100k(F.col("total"), F.col("people")).alias("Casos por 100 mil hab."),
        )

    return build


def population(macroregions: DataFrame, by_city: bool) -> DataFrame:
    coded = macroregions.where(F.upper("ADM2_PCODE").startswith("BR"))
    people = F.col("Populacao").cast("int")
    if by_city:
        code = F.regexp_replace("ADM2_PCODE", "^BR", "").cast("int")
        return coded.select(code.alias("location_ibge_code"), people.alias("people"))
    return coded.groupBy(F.col("DS_UF_SIGLA").alias("state_code")).agg(F.sum(people).alias("people"))


# -- laboratories beside the register ----------------------------------------


def beside_register(pathogen: str, kit_names: Sequence[str], start: str | None, label: str) -> Callable:
    """National rate of the laboratories beside the register's weekly positives."""

    def build(src: Source) -> DataFrame:
        since = from_week(start) if start else F.lit(True)
        week = "Semanas epidemiológicas"
        labs = (
            src.facts.where(has_tested(pathogen) & kits(kit_names) & since)
            .groupBy(F.col(WEEK).alias(week))
            .agg(percent(pathogen).alias("Positividade (%, Lab. parceiros)"))
        )
        severe = (
            src.register.where(has_tested(pathogen) & since)
            .groupBy(F.col(WEEK).alias(week))
            .agg(count(pos(pathogen)).alias(f"Infecções graves por {label} (SIVEP)"))
        )
        return labs.join(severe, week, "full")

    return build


def regions_beside_register(pathogen: str, kit_names: Sequence[str], by_state: bool = False) -> Callable:
    """Regional rates beside the register's positives per region, and per state when asked.

    National rates are those of weeks in which a laboratory sample exists.
    """
    week = "Semanas epidemiológicas"

    def build(src: Source, states: Sequence[str] | None = None) -> DataFrame:
        start = from_week("2022-03-01")
        labs = src.facts.where(has_tested(pathogen) & kits(kit_names) & start)
        by_region = labs.groupBy(WEEK, "region").agg(pos(pathogen).alias("p"), neg(pathogen).alias("n"))
        regional = positivity_rate(F.col("p"), F.col("n")) * 100
        national = positivity_rate(F.sum("p"), F.sum("n")) * 100
        lab_side = by_region.groupBy(WEEK).agg(
            national.alias("Brasil (Positividade)"),
            *[F.max(F.when(F.col("region") == r, regional)).alias(f"{r} (Positividade)") for r in REGIONS],
        )
        keys = ["region", "state"] if by_state else ["region"]
        severe = src.register.where(has_tested(pathogen) & start).groupBy(WEEK, *keys).agg(pos(pathogen).alias("p"))

        def total(column: str, value: str) -> Column:
            return F.sum(F.when(F.col(column) == value, F.col("p")).otherwise(0)).alias(f"{value} (SRAG)")

        totals = [total("region", r) for r in REGIONS]
        if by_state:
            names = states if states is not None else distinct_values(src.register.where(start), "state")
            totals += [total("state", s) for s in names]
        return one_row_per_week(lab_side, severe.groupBy(WEEK).agg(*totals), week)

    return build


def one_row_per_week(labs: DataFrame, severe: DataFrame, week: str) -> DataFrame:
    zeros = [c for c in severe.columns if c != WEEK]
    return labs.join(severe, WEEK, "full").select(
        F.col(WEEK).alias(week),
        *[f"`{c}`" for c in labs.columns if c != WEEK],
        *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(c) for c in zeros],
    )


# -- flat extracts -----------------------------------------------------------


def all_counts(src: Source) -> DataFrame:
    """Conclusive results by laboratory and kit. The pathogens are unpivoted after aggregation."""
    summed = src.lab_facts.groupBy(*fx.LAB_KEYS).agg(*[F.sum(c).alias(c) for c in fx.COUNTERS])
    cells = F.array(
        *[
            F.struct(F.lit(p).alias("pathogen"), F.lit(label).alias("result"), F.col(f"{p}_{side}").alias("count"))
            for p in PATHOGENS
            for side, label in (("pos", "Pos"), ("neg", "Neg"))
        ]
    )
    return summed.select(*fx.LAB_KEYS, F.inline(cells)).where(F.col("count") > 0)


def state_rates(src: Source) -> DataFrame:
    return (
        src.facts.groupBy(F.col(WEEK).alias("semanas_epidemiologicas"), F.col("state_code").alias("UF"))
        .agg(percent("SC2").alias("percentual"))
        .where(F.col("percentual").isNotNull())
    )


# -- variants of a parent ----------------------------------------------------


def recent_of(parent: str, column: str, days: int = 364, also: Callable[[], Column] | None = None) -> Callable:
    def build(src: Source) -> DataFrame:
        df = recent(build_matrix(parent, src), column, days)
        return df if also is None else df.where(also())

    return build


def latest_of(parent: str, column: str) -> Callable:
    return lambda src: latest(build_matrix(parent, src), column)


def graded_of(parent: str, *grades: str) -> Callable:
    return lambda src: build_matrix(parent, src).where(F.col("Completude final").isin(*grades))


# -- catalogue ---------------------------------------------------------------

_WEEK_LOWER, _WEEK_UPPER, _WEEK_SNAKE = "semana epidemiológica", "Semana epidemiológica", "semana_epidemiológica"
_WEEKS_SNAKE, _WEEKS_PLAIN, _WEEKS = "semanas_epidemiologicas", "semanas epidemiologicas", "Semanas epidemiológicas"
_AGE_KEYS = ((WEEK, _WEEK_SNAKE), ("age_group", "faixas_etárias"))


def _asc(*columns: str) -> tuple[tuple[str, str], ...]:
    return tuple((c, "asc") for c in columns)


_CITY = ["location_ibge_code", "location", "state", "lat", "long"]
_STATE = ["state_code", "state"]
_BY_AGE = ((_WEEK_UPPER, "asc"), ("Faixa etária", "desc"))

MATRICES: dict[str, Matrix] = {
    "matrix_01_VRISP_line_posrate_direct_week_country_h": Matrix(rate_lines(FOUR, lambda: routes(*FOUR_ROUTES)), _asc(_WEEK_LOWER)),
    "matrix_02_Resp_bar_pos_panel4_week_country_h": Matrix(
        count_bars(FOUR, lambda: routes(*PANEL4_ROUTES) & from_week("2022-02-26")), _asc(_WEEK_LOWER)
    ),
    "matrix_03_SC2_heat_posrate_week_state": Matrix(state_heat, _asc(_WEEKS_SNAKE, "UF")),
    "matrix_04_SC2_heat_posrate_agegroups_week_country_h": Matrix(
        age_heat("SC2", vocab.SC2_KITS, "Taxa de positividade"), _BY_AGE
    ),
    "matrix_05_FLUA_heat_posrate_agegroups_week_country_h": Matrix(age_heat("FLUA", vocab.FLU_KITS, "Positividade"), _BY_AGE),
    "matrix_06_Resp_line_posrate_direct_week_country_h": Matrix(rate_lines(OTHERS, lambda: routes(*OTHER_ROUTES)), _asc(_WEEK_LOWER)),
    "matrix_07_Resp_bar_pos_panel20PLUS_week_country_h": Matrix(
        count_bars(PANEL20, lambda: kits(vocab.PANEL20_KITS)), _asc(_WEEK_LOWER), "07_Resp_bar_pos_panel20+_week_country_h"
    ),
    "matrix_08_Resp_line_bar_posrate_posneg_week_country_h": Matrix(overall_line, _asc(_WEEKS_SNAKE)),
    "matrix_09_Resp_pyr_pos_agegroups_all_week_country_h": Matrix(
        count_bars(PYRAMID, lambda: routes(*PYRAMID_ROUTES), _AGE_KEYS), _asc(_WEEK_SNAKE, "faixas_etárias")
    ),
    "matrix_10_Resp_pyr_pos_agegroups_panel4_week_country_h": Matrix(
        count_bars(
            FOUR,
            lambda: from_week("2022-01-01") & (F.col("age_group") != NOT_REPORTED) & routes(*PANEL4_ROUTES),
            _AGE_KEYS,
        ),
        _asc(_WEEK_SNAKE, "faixas_etárias"),
    ),
    "matrix_13_SC2_map_pos_direct_cities_h": Matrix(
        case_map("SC2", "2025-06-14", vocab.SC2_KITS, _CITY, _WEEKS_PLAIN, code_as_state=True),
        _asc(_WEEKS_PLAIN, "state", "location"),
    ),
    "matrix_13_SC2_map_pos_direct_states_h": Matrix(
        case_map("SC2", "2025-06-14", vocab.SC2_KITS, _STATE, _WEEKS_PLAIN),
        _asc(_WEEKS_PLAIN, "state_code"),
    ),
    "matrix_14_FLUB_map_pos_direct_cities_h": Matrix(
        case_map("FLUB", "2025-09-13", vocab.FLU_KITS, _CITY, _WEEKS_PLAIN),
        _asc(_WEEKS_PLAIN, "state", "location"),
    ),
    "matrix_14_FLUB_map_pos_direct_states_h": Matrix(
        case_map("FLUB", "2025-09-13", vocab.FLU_KITS, _STATE, _WEEKS_PLAIN),
        _asc(_WEEKS_PLAIN, "state_code"),
    ),
    "matrix_15_FLUB_heat_posrate_agegroups_week_country_h": Matrix(age_heat("FLUB", vocab.FLU_KITS, "Positividade"), _BY_AGE),
    "matrix_16_VSR_map_pos_direct_cities_h": Matrix(
        case_map(
            "VSR", "2025-12-21", vocab.VSR_KITS, ["location_ibge_code", "location", "state_code", "state", "lat", "long"],
            "Semanas epidemiologicas", tested_only=True, renames=CAPITALS,
        ),
        _asc("Semanas epidemiologicas", "State_code", "Location"),
    ),
    "matrix_16_VSR_map_pos_direct_states_h": Matrix(
        case_map("VSR", "2025-12-21", vocab.VSR_KITS, _STATE, _WEEKS, tested_only=True, renames=CAPITALS),
        _asc("State_code", _WEEKS),
    ),
    "matrix_17_SC2_line_posrate_bar_pos_direct_week_country_sivep": Matrix(
        beside_register("SC2", vocab.SC2_REGISTER_KITS, "2022-03-01", "SARS-CoV-2"), _asc(_WEEKS)
    ),
    "matrix_18_VSR_line_posrate_bar_pos_direct_week_country_sivep": Matrix(
        beside_register("VSR", vocab.VSR_KITS, None, "VSR"), _asc(_WEEKS)
    ),
    "matrix_19_FLUA_line_posrate_bar_pos_direct_week_country_sivep": Matrix(
        beside_register("FLUA", vocab.FLU_KITS, None, "Influenza A"), _asc(_WEEKS)
    ),
    "matrix_20_FLUB_line_posrate_bar_pos_direct_week_country_sivep": Matrix(
        beside_register("FLUB", vocab.FLU_KITS, None, "Influenza B"), _asc(_WEEKS)
    ),
    "matrix_21_SC2_line_posrate_direct_week_country_annual": Matrix(
        annual_lines("SC2", vocab.SC2_KITS), _asc("semana epidemiológica  (SE)")
    ),
    "matrix_22_VSR_line_posrate_direct_week_country_annual": Matrix(
        annual_lines("VSR", vocab.VSR_KITS), _asc("semana epidemiológica  (SE)")
    ),
    "matrix_23_FLUA_line_posrate_direct_week_country_annual": Matrix(
        annual_lines("FLUA", vocab.FLU_KITS), _asc("semana epidemiológica  (SE)")
    ),
    "matrix_24_FLUB_line_posrate_direct_week_country_annual": Matrix(
        annual_lines("FLUB", vocab.FLU_KITS), _asc("semana epidemiológica  (SE)")
    ),
    "matrix_25_FLUA_map_pos_direct_cities_h": Matrix(
        case_map(
            "FLUA", "2025-08-10", vocab.FLU_KITS, ["location_ibge_code", "location", "state", "state_code", "lat", "long"],
            _WEEKS_PLAIN, tested_only=True,
        ),
        _asc(_WEEKS_PLAIN, "state", "location"),
    ),
    "matrix_25_FLUA_map_pos_direct_states_h": Matrix(
        case_map("FLUA", "2025-08-10", vocab.FLU_KITS, _STATE, _WEEKS_PLAIN, tested_only=True),
        _asc(_WEEKS_PLAIN, "state_code"),
    ),
    "matrix_30_Resp_bar_total_posneg_months_regions": Matrix(
        volume_bars("month", "month_sample", "Ano-Mês", lambda: F.col("month") >= "2022-01"), _asc("Ano-Mês")
    ),
    "matrix_30_Resp_bar_total_posneg_week_regions": Matrix(
        volume_bars(WEEK, "week_sample", "Semana Epidemiológica", lambda: from_week("2022-01-01")), _asc("Semana Epidemiológica")
    ),
    "matrix_31_Resp_pyr_pos_agegroups_all_quarter_country": Matrix(
        quarter_pyramid, (("trimestre", "asc"), ("faixas_etarias", "desc"))
    ),
    "matrix_34_SC2_line_posrate_bar_pos_direct_week_regions_sivep": Matrix(
        regions_beside_register("SC2", vocab.SC2_REGISTER_KITS, by_state=True), _asc(_WEEKS)
    ),
    "matrix_35_FLUA_line_posrate_bar_pos_direct_week_regions_sivep": Matrix(
        regions_beside_register("FLUA", vocab.FLU_KITS), _asc(_WEEKS)
    ),
    "matrix_36_FLUB_line_posrate_bar_pos_direct_week_regions_sivep": Matrix(
        regions_beside_register("FLUB", vocab.FLU_KITS), _asc(_WEEKS)
    ),
    "matrix_37_VSR_line_posrate_bar_pos_direct_week_regions_sivep": Matrix(
        regions_beside_register("VSR", vocab.VSR_KITS), _asc(_WEEKS)
    ),
    "matrix_101_VRISP_posrate_posneg_week_region": Matrix(
        flat_rates([(WEEK, _WEEKS), ("region", "Região")]), _asc(_WEEKS, "Região", "Patógeno")
    ),
    "matrix_102_VRISP_posrate_posneg_week_state": Matrix(
        flat_rates([(WEEK, _WEEKS), ("region", "Região"), ("state", "Estado"), ("state_code", "Código do Estado")]),
        _asc(_WEEKS, "Região", "Estado", "Código do Estado", "Patógeno"),
    ),
    "matrix_ALL_count_by_labid_testkit_pathogen_result": Matrix(
        all_counts, _asc("lab_id", "test_kit", "pathogen", "result"), "matrix_ALL_count_by_labid_testkit_pathogen_result"
    ),
    "matrix_SC2_posrate_by_epiweek_state": Matrix(
        state_rates, _asc(_WEEKS_SNAKE, "UF"), "matrix_SC2_posrate_by_epiweek_state"
    ),
}

# -- recency variants: name of the parent, its day column, days back
_RECENT = [
    ("matrix_01_VRISP_line_posrate_direct_week_country", _WEEK_LOWER, 364),
    ("matrix_02_Resp_bar_pos_panel4_week_country", _WEEK_LOWER, 364),
    ("matrix_04_SC2_heat_posrate_agegroups_week_country", _WEEK_UPPER, 364),
    ("matrix_05_FLUA_heat_posrate_agegroups_week_country", _WEEK_UPPER, 364),
    ("matrix_06_Resp_line_posrate_direct_week_country", _WEEK_LOWER, 364),
    ("matrix_07_Resp_bar_pos_panel20PLUS_week_country", _WEEK_LOWER, 364),
    ("matrix_08_Resp_line_bar_posrate_posneg_week_country", _WEEKS_SNAKE, 364),
    ("matrix_09_Resp_pyr_pos_agegroups_all_week_country", _WEEK_SNAKE, 56),
    ("matrix_10_Resp_pyr_pos_agegroups_panel4_week_country", _WEEK_SNAKE, 56),
    ("matrix_15_FLUB_heat_posrate_agegroups_week_country", _WEEK_UPPER, 364),
]
_LATEST = [
    ("matrix_13_SC2_map_pos_direct_cities", _WEEKS_PLAIN),
    ("matrix_13_SC2_map_pos_direct_states", _WEEKS_PLAIN),
    ("matrix_14_FLUB_map_pos_direct_cities", _WEEKS_PLAIN),
    ("matrix_14_FLUB_map_pos_direct_states", _WEEKS_PLAIN),
    ("matrix_16_VSR_map_pos_direct_cities", "Semanas epidemiologicas"),
    ("matrix_16_VSR_map_pos_direct_states", _WEEKS),
    ("matrix_25_FLUA_map_pos_direct_cities", _WEEKS_PLAIN),
    ("matrix_25_FLUA_map_pos_direct_states", _WEEKS_PLAIN),
]
for _name, _column, _days in _RECENT:
    _file = "07_Resp_bar_pos_panel20+_week_country_r" if "panel20PLUS" in _name else None
    MATRICES[f"{_name}_r"] = Matrix(recent_of(f"{_name}_h", _column, _days), MATRICES[f"{_name}_h"].order, _file)
for _name, _column in _LATEST:
    MATRICES[f"{_name}_r"] = Matrix(latest_of(f"{_name}_h", _column), MATRICES[f"{_name}_h"].order)
MATRICES["matrix_01_VRISP_line_posrate_direct_week_country_c"] = Matrix(
    recent_of("matrix_01_VRISP_line_posrate_direct_week_country_h", _WEEK_LOWER, 70), _asc(_WEEK_LOWER)
)
_HEAT = "matrix_03_SC2_heat_posrate_week_state"
MATRICES[f"{_HEAT}_h"] = Matrix(graded_of(_HEAT, "Apenas histórico", "Alta qualidade"), MATRICES[_HEAT].order)
MATRICES[f"{_HEAT}_r"] = Matrix(
    recent_of(_HEAT, _WEEKS_SNAKE, 364, lambda: F.col("Completude final").isin("Apenas 12 meses", "Alta qualidade")),
    MATRICES[_HEAT].order,
)


def build_matrix(name: str, src: Source) -> DataFrame:
    return MATRICES[name].build(src)


def build_all(src: Source, names: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Every table from the shared aggregates."""
    ready = shared(src)
    return {name: build_matrix(name, ready) for name in (names or MATRICES)}


def file_name(name: str) -> str:
    """Published file name of a table."""
    return MATRICES[name].file_name or name.removeprefix("matrix_")
