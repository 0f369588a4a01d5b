"""The eight laboratories: raw text rows to one row per sample.

Each plan is typed projection -> value fixing -> one-hot -> collapse. All
steps but the collapse are narrow and fuse into the scan's stage; the
collapse is the only exchange. Adding a laboratory means adding a ``LabPlan``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labwatch import labs_vocab as lv
from labwatch.functions.ages import clamp_age, completed_years, parse_age_text
from labwatch.functions.convert import integer_text, to_date, to_int
from labwatch.functions.dates import as_date
from labwatch.functions.keys import sample_key
from labwatch.functions.mapping import by_prefix, first_of, lookup, sex_by_prefix, sex_exact, state_name
from labwatch.functions.results import row_max, three_way, two_way
from labwatch.functions.text import normalize_text, remove_terms, squeeze, starts_with, unaccent
from labwatch.operators.collapse import fill_and_keep_one, keep_one, one_hot
from labwatch.operators.reshape import computed_once, split_combined_test
from labwatch.operators.upsert import keep_decisive, merge, stamp
from labwatch.vocab import PATHOGENS, UNDETERMINED, UNRECOGNISED

CARRIED = ["test_id", "test_kit", "sex", "age", "location", "state", "date_testing", "patient_id", "file_name"]
UNKNOWN_KIT = "UNKNOWN"


@dataclass(frozen=True)
class LabPlan:
    """How one laboratory's rows become samples."""

    lab_id: str
    typed: Callable[[DataFrame], DataFrame]
    fixed: Callable[[DataFrame], DataFrame]
    hot: Callable[[DataFrame], DataFrame]
    count_lines: bool = True
    decisive_merge: bool = False

    def long(self, raw: DataFrame) -> DataFrame:
        return self.fixed(self.typed(raw))

    def pivoted(self, raw: DataFrame) -> DataFrame:
        return self.hot(self.long(raw))

    def wide(self, raw: DataFrame) -> DataFrame:
        rows = self.pivoted(raw)
        if "patient_id" not in rows.columns:
            rows = rows.withColumn("patient_id", F.lit(None).cast("string"))
        return fill_and_keep_one(rows, CARRIED, count_lines=self.count_lines)


def _hot(analytes: Mapping[str, Sequence[str]], source: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: one_hot(df, analytes, source)


def _norm(name: str) -> Column:
    return normalize_text(F.col(f"`{name}`"))


# -- DB Molecular ------------------------------------------------------------


def dbmol_typed(raw: DataFrame) -> DataFrame:
    return computed_once(
        raw,
        integer_text(F.col("NumeroPedido")).alias("test_id"),
        F.col("Sexo").alias("sex"),
        _norm("Procedimento").alias("exame"),
        _norm("CodigoProcedimento").alias("codigo_exame"),
        _norm("Parametro").alias("detalhe_exame"),
        to_date(F.col("DataCadastro"), "yyyy-M-d").alias("date_testing"),
        to_date(F.col("DataNascimento"), "yyyy-M-d").alias("data_nascimento"),
        _norm("Cidade").alias("location"),
        _norm("UF").alias("state_code"),
        _norm("Resultado").alias("result"),
        "file_name",
    )


def dbmol_result(code: Column, result: Column) -> Column:
    """Words for the word-coded exams, cut-offs for the quantitative ones."""
    bare = remove_terms(result, lv.DBMOL_BOUND_TERMS)
    below = starts_with(result, lv.DBMOL_BOUND_TERMS[0].rstrip())
    words = first_of(
        (result.isin(lv.DBMOL_NEGATIVE_WORDS) | below, 0),
        (result.isin(lv.DBMOL_POSITIVE_WORDS) | starts_with(result, "DETECTADO "), 1),
        default=UNRECOGNISED,
    )
    branches = [(code.isin(lv.DBMOL_WORD_CODES), words)]
    # the bounds are looked up: a branch for each code would outgrow what the JVM compiles as one method
    low, high = (lookup(code, {c: bounds[i] for c, bounds in lv.DBMOL_THREE_WAY.items()}) for i in range(2))
    branches += [(code.isin(list(lv.DBMOL_THREE_WAY)), three_way(bare, low, high))]
    branches += [(code.isin(list(lv.DBMOL_TWO_WAY)), two_way(bare, lookup(code, lv.DBMOL_TWO_WAY)))]
    branches += [
        ((code == "INFAG") & below, F.lit(0)),
        ((code == "INFAG") & ~below, three_way(result, *lv.DBMOL_INFAG_RANGE)),
    ]
    return first_of(*branches, default=UNRECOGNISED)


def dbmol_fixed(typed: DataFrame) -> DataFrame:
    code, exam = F.col("codigo_exame"), F.col("exame")
    kept = typed.where(
        code.isin(lv.DBMOL_KEPT_CODES)
        & ~F.col("detalhe_exame").isin(lv.DBMOL_DROPPED_PARAMETERS)
        & ~F.col("result").isin(lv.DBMOL_DROPPED_RESULTS)
    )
    panel_or_analyte = F.when(code.isin(lv.DBMOL_PANEL_CODES), code).otherwise(F.col("detalhe_exame"))
    fixed = computed_once(
        kept,
        sample_key(F.col("test_id"), exam, panel_or_analyte).alias("sample_id"),
        "test_id",
        "date_testing",
        clamp_age(completed_years(F.col("date_testing"), F.col("data_nascimento")), low=None).alias("age"),
        lookup(exam, lv.DBMOL_KITS, UNKNOWN_KIT).alias("test_kit"),
        "codigo_exame",
        "detalhe_exame",
        "exame",
        dbmol_result(code, F.col("result")).alias("result"),
        sex_exact(F.col("sex")).alias("sex"),
        "location",
        "state_code",
        state_name(F.col("state_code")).alias("state"),
        "file_name",
    )
    return fixed.where(F.col("result") != UNDETERMINED)


# -- Einstein ----------------------------------------------------------------


def einstein_typed(raw: DataFrame) -> DataFrame:
    return computed_once(
        raw,
        F.col("accession").cast("string").alias("test_id"),
        F.col("sexo").alias("sex"),
        to_int(F.col("idade")).alias("age"),
        _norm("exame").alias("exame"),
        _norm("detalhe_exame").alias("detalhe_exame"),
        to_date(F.col("dh_coleta"), "d/M/yyyy").alias("date_testing"),
        _norm("municipio").alias("location"),
        _norm("estado").alias("state"),
        F.col("patogeno").alias("pathogen"),
        _norm("resultado").alias("result"),
        "file_name",
    ).distinct()


def einstein_fixed(typed: DataFrame) -> DataFrame:
    exam = F.col("exame")
    panel = F.when(exam.isin(lv.EINSTEIN_PANELS), exam)
    prefix_panel = by_prefix(exam, lv.EINSTEIN_PANEL_PREFIXES)
    kit = F.coalesce(lookup(exam, lv.EINSTEIN_KITS), by_prefix(exam, lv.EINSTEIN_KIT_PREFIXES), F.lit(UNKNOWN_KIT))
    rows = typed.select(
        sample_key(F.col("test_id"), exam, F.coalesce(panel, prefix_panel, F.col("detalhe_exame"))).alias("sample_id"),
        "test_id",
        sex_by_prefix(F.col("sex")).alias("sex"),
        clamp_age(F.col("age")).alias("age"),
        "exame",
        squeeze(F.col("detalhe_exame")).alias("detalhe_exame"),
        "date_testing",
        "location",
        "state",
        "pathogen",
        lookup(F.col("result"), lv.EINSTEIN_RESULTS).alias("result"),
        kit.alias("test_kit"),
        "file_name",
    )
    # The exclusions of two faulty loads (ages 182 and 124) need no plan: both
    # ages are cleared by the clamp above and both loads precede the start day.
    return rows.where(~starts_with(exam, lv.EINSTEIN_TEST_PREFIX) & (F.col("date_testing") >= as_date(lv.EINSTEIN_START)))


# -- Fleury ------------------------------------------------------------------


def fleury_typed(raw: DataFrame) -> DataFrame:
    kept = raw.where(F.col("EXAME").isNotNull())
    return computed_once(
        kept,
        F.col("`CODIGO REQUISICAO`").alias("test_id"),
        to_date(F.col("`DATA COLETA`"), "d/M/yyyy").alias("date_testing"),
        F.col("PACIENTE").alias("patient_id"),
        F.col("SEXO").alias("sex"),
        F.col("IDADE").alias("age"),
        _norm("MUNICIPIO").alias("location"),
        _norm("ESTADO").alias("state_code"),
        _norm("EXAME").alias("exame"),
        _norm("PATOGENO").alias("pathogen"),
        _norm("RESULTADO").alias("result"),
        "file_name",
    )


def fleury_fixed(typed: DataFrame) -> DataFrame:
    exam = F.col("exame")
    rows = typed.where(
        ~exam.isin(lv.FLEURY_DROPPED_EXAMS)
        & ~F.col("test_id").isin(lv.FLEURY_DROPPED_TESTS)
        & ~F.col("result").isin(lv.FLEURY_DROPPED_RESULTS)
        & ~F.col("pathogen").isin(lv.FLEURY_DROPPED_PATHOGENS)
    ).select(
        sample_key(F.col("test_id"), exam).alias("sample_id"),
        "test_id",
        "date_testing",
        "patient_id",
        "sex",
        parse_age_text(F.col("age"), otherwise=-1).alias("age"),
        "location",
        state_name(F.col("state_code")).alias("state"),
        "exame",
        lookup(exam, lv.FLEURY_KITS, UNKNOWN_KIT).alias("test_kit"),
        "pathogen",
        "result",
        "file_name",
    )
    combined = F.col("pathogen") == lv.FLEURY_RAPID_AB
    split = split_combined_test(
        rows,
        is_combined=combined & (exam == lv.FLEURY_RAPID_EXAM) & (F.col("result") != "INCONCLUSIVO"),
        is_plain=~combined,
        outcomes=lv.FLEURY_RAPID_RESULTS,
        names=(lv.FLEURY_RAPID_A, lv.FLEURY_RAPID_B),
    )
    return split.withColumn("result", lookup(F.col("result"), lv.FLEURY_RESULTS, UNRECOGNISED))


# -- Hilab -------------------------------------------------------------------


def hilab_typed(raw: DataFrame) -> DataFrame:
    kept = raw.where(
        ~F.col("Exame").isin(lv.HILAB_DROPPED_EXAMS) & ~F.col("Resultado").isin(lv.HILAB_DROPPED_RESULTS)
    )
    return computed_once(
        kept,
        F.col("`Código Da Cápsula`").alias("test_id"),
        _norm("Estado").alias("state_code"),
        _norm("Cidade").alias("location"),
        to_date(F.col("`Data Do Exame`"), "d/M/yyyy").alias("date_testing"),
        _norm("Exame").alias("exame"),
        _norm("Resultado").alias("result"),
        to_int(F.col("Idade")).alias("age"),
        F.col("Paciente").alias("patient_id"),
        _norm("Sexo").alias("sex"),
        "file_name",
    )


def hilab_fixed(typed: DataFrame) -> DataFrame:
    key = sample_key(F.col("test_id"), F.col("exame"), F.col("patient_id"))
    single = keep_one(typed.withColumn("sample_id", key), "sample_id")
    return single.select(
        "sample_id",
        "test_id",
        "state_code",
        "location",
        "date_testing",
        "exame",
        lookup(F.col("exame"), lv.HILAB_KITS, UNKNOWN_KIT).alias("test_kit"),
        lookup(F.col("result"), lv.HILAB_RESULTS, UNRECOGNISED).alias("result"),
        state_name(F.col("state_code")).alias("state"),
        clamp_age(F.col("age")).alias("age"),
        "patient_id",
        sex_by_prefix(F.col("sex")).alias("sex"),
        "file_name",
    )


# -- HLAGyn ------------------------------------------------------------------


def hlagyn_typed(raw: DataFrame) -> DataFrame:
    """The 29 result columns are cleaned by one lambda as an array: spelled out, they would outgrow one method."""
    rows = computed_once(
        raw,
        F.col("Pedido").alias("test_id"),
        to_date(F.col("`Data Coleta`"), "yyyy-M-d").alias("date_testing"),
        to_int(F.col("Idade")).alias("age"),
        _norm("Sexo").alias("sex"),
        _norm("Métodologia").alias("detalhe_exame"),
        _norm("Cidade").alias("location"),
        _norm("UF").alias("state_code"),
        F.transform(F.array(*[F.col(f"`{header}`") for header in lv.HLAGYN_COLUMNS]), normalize_text).alias("_cleaned"),
        "file_name",
    )
    cleaned = [F.col("_cleaned")[i].alias(name) for i, name in enumerate(lv.HLAGYN_COLUMNS.values())]
    return rows.select(*[c for c in rows.columns if c not in ("_cleaned", "file_name")], *cleaned, "file_name")


def hlagyn_fixed(typed: DataFrame) -> DataFrame:
    """The 29 result columns go through one lambda as an array: spelled out 29 times, the same
    conditions would outgrow what the JVM compiles as one method."""
    results = list(lv.HLAGYN_COLUMNS.values())

    def code(c: Column) -> Column:
        return first_of(
            (starts_with(c, "NAO DETECTADO"), 0),
            (starts_with(c, "DETECTADO"), 1),
            (c == "INCONCLUSIVO", -1),
            (c.isNull(), -1),
            default=UNRECOGNISED,
        )

    kit = first_of(
        (F.col(lv.HLAGYN_COLUMNS["Resultado"]).isNotNull(), "covid_pcr"),
        (F.col(lv.HLAGYN_COLUMNS["Vírus Influenza A"]).isNotNull(), "test_4"),
        (F.col(lv.HLAGYN_COLUMNS["VIRUS_IA"]).isNotNull(), "test_24"),
        default=UNKNOWN_KIT,
    )
    listed = computed_once(typed, *[c for c in typed.columns if c not in results], kit.alias("test_kit"), F.array(*results).alias("_results"))
    informative = F.exists("_results", lambda c: c.isNotNull() & (c != "INCONCLUSIVO"))
    coded = computed_once(
        listed.where(informative),
        sample_key(F.col("test_id"), F.col("detalhe_exame")).alias("sample_id"),
        "test_id",
        "date_testing",
        clamp_age(F.col("age")).alias("age"),
        sex_by_prefix(F.col("sex")).alias("sex"),
        "detalhe_exame",
        "location",
        "state_code",
        state_name(F.col("state_code")).alias("state"),
        "test_kit",
        F.transform("_results", code).alias("_codes"),
        "file_name",
    )
    return coded.select(
        *[c for c in coded.columns if c != "_codes"], *[F.col("_codes")[i].alias(r) for i, r in enumerate(results)]
    )


def hlagyn_hot(fixed: DataFrame) -> DataFrame:
    """Result columns of one pathogen to their highest code."""
    results = list(lv.HLAGYN_COLUMNS.values())
    others = [c for c in fixed.columns if c not in results]
    return fixed.select(
        *others,
        *[row_max(*[F.col(lv.HLAGYN_COLUMNS[h]) for h in lv.HLAGYN_RESULTS[p]]).alias(f"{p}_test_result") for p in PATHOGENS],
    )


# -- Hermes Pardini ----------------------------------------------------------


def hpardini_typed(raw: DataFrame) -> DataFrame:
    return computed_once(
        raw,
        F.col("CODIGO").alias("test_id"),
        to_date(F.col("DATACOLETA"), "yyyy-M-d").alias("date_testing"),
        _norm("PATÓGENO").alias("pathogen"),
        _norm("MÉTODO").alias("detalhe_exame"),
        _norm("CIDADE").alias("location"),
        _norm("UF").alias("state"),
        F.col("SEXO").alias("sex"),
        to_int(F.col("IDADE")).alias("age"),
        _norm("RESULTADO").alias("result"),
        "file_name",
    )


def hpardini_fixed(typed: DataFrame) -> DataFrame:
    pathogen, method = lv.HPARDINI_PCR
    return typed.where(~F.col("pathogen").isin(lv.HPARDINI_DROPPED_PATHOGENS)).select(
        F.md5("test_id").alias("sample_id"),
        "test_id",
        sex_by_prefix(F.col("sex")).alias("sex"),
        clamp_age(F.col("age")).alias("age"),
        "date_testing",
        "location",
        state_name(F.col("state")).alias("state"),
        "pathogen",
        "detalhe_exame",
        lookup(F.col("result"), lv.HPARDINI_RESULTS).alias("result"),
        F.when((F.col("pathogen") == pathogen) & (F.col("detalhe_exame") == method), "covid_pcr")
        .otherwise(UNKNOWN_KIT)
        .alias("test_kit"),
        "file_name",
    )


# -- Sabin -------------------------------------------------------------------


def sabin_typed(raw: DataFrame) -> DataFrame:
    """Dates are month first; ``sources.header_repair`` finds day-first deliveries and turns theirs."""
    return computed_once(
        raw,
        F.col("OS").alias("test_id"),
        _norm("Estado").alias("state"),
        _norm("Municipio").alias("location"),
        to_date(F.col("DataAtendimento"), "M/d/yyyy").alias("date_testing"),
        to_date(F.col("DataNascimento"), "M/d/yyyy").alias("birth_date"),
        F.col("Sexo").alias("sex"),
        F.col("Descricao").alias("exame"),
        F.col("Parametro").alias("detalhe_exame"),
        unaccent(F.upper(F.trim("Resultado"))).alias("result"),
        "file_name",
    )


def sabin_fixed(typed: DataFrame) -> DataFrame:
    parameter, exam, result = F.col("detalhe_exame"), F.col("exame"), F.col("result")
    panel = F.coalesce(
        F.when(parameter.isin(lv.SABIN_PAIRED_TARGETS), lv.SABIN_PAIRED_KEY),
        by_prefix(exam, lv.SABIN_PANEL_PREFIXES),
        parameter,
    )
    code = first_of(
        (starts_with(result, "NAO DETECTAD"), 0),
        (starts_with(result, "DETECTAD"), 1),
        (result.isin(lv.SABIN_POSITIVE_NAMES), 1),
        (result == "0", 0),
        (starts_with(result, "NAO REAGENTE"), 0),
        (starts_with(result, "REAGENTE"), 1),
        default=UNRECOGNISED,
    )
    kits = {
        "covid_pcr": lv.SABIN_SINGLE_PCR,
        "covid_antigen": lv.SABIN_ANTIGEN,
        "test_21": lv.SABIN_TEST_21,
        "test_24": lv.SABIN_TEST_24,
        "test_4": lv.SABIN_TEST_4,
    }
    # Only parameters with a kit are kept, which leaves out controls, notes and all other exams.
    return typed.where(parameter.isin([p for names in kits.values() for p in names])).select(
        sample_key(F.col("test_id"), exam, panel).alias("sample_id"),
        "test_id",
        "state",
        "location",
        "date_testing",
        "birth_date",
        sex_by_prefix(F.col("sex")).alias("sex"),
        completed_years(F.col("date_testing"), F.col("birth_date")).alias("age"),
        "exame",
        "detalhe_exame",
        code.alias("result"),
        first_of(*[(parameter.isin(names), kit) for kit, names in kits.items()], default=UNKNOWN_KIT).alias("test_kit"),
        "file_name",
    )


# -- Target ------------------------------------------------------------------


def target_typed(raw: DataFrame) -> DataFrame:
    order = integer_text(F.col("`Numerdo do Pedido`"))
    kept = raw.where(~order.isin(lv.TARGET_DROPPED_TESTS))
    return computed_once(
        kept,
        order.alias("test_id"),
        integer_text(F.col("`Código da Amostra`")).alias("codigo_amostra"),
        to_date(F.col("`Data de Coleta`"), "d/M/yyyy").alias("date_testing"),
        F.col("Sexo").alias("sex"),
        _norm("Idade").alias("age"),
        _norm("Município").alias("location"),
        _norm("Estado").alias("state_code"),
        _norm("Exame").alias("exame"),
        _norm("Nome exame").alias("nome_exame"),
        F.col("`Cód. Pátógeno`").alias("detalhe_exame"),
        _norm("Patógeno").alias("pathogen"),
        _norm("Resultado").alias("result"),
        "file_name",
    )


def target_fixed(typed: DataFrame) -> DataFrame:
    result = F.col("result")
    code = F.coalesce(
        lookup(result, lv.TARGET_RESULTS), F.when(starts_with(result, lv.TARGET_POSITIVE_PREFIX), 1)
    )
    return typed.where(
        ~F.col("exame").isin(lv.TARGET_DROPPED_EXAMS) & ~result.isin(lv.TARGET_DROPPED_RESULTS)
    ).select(
        sample_key(F.col("test_id"), F.col("exame")).alias("sample_id"),
        "test_id",
        "date_testing",
        sex_exact(F.col("sex")).alias("sex"),
        parse_age_text(F.col("age")).alias("age"),
        "location",
        state_name(F.col("state_code")).alias("state"),
        "exame",
        "detalhe_exame",
        "pathogen",
        lookup(F.col("exame"), lv.TARGET_KITS).alias("test_kit"),
        code.alias("result"),
        "file_name",
    )


LABS: dict[str, LabPlan] = {
    plan.lab_id: plan
    for plan in [
        LabPlan("EINSTEIN", einstein_typed, einstein_fixed, _hot(lv.EINSTEIN_ANALYTES, "detalhe_exame"), decisive_merge=True),
        LabPlan("FLEURY", fleury_typed, fleury_fixed, _hot(lv.FLEURY_ANALYTES, "pathogen")),
        LabPlan("SABIN", sabin_typed, sabin_fixed, _hot(lv.SABIN_ANALYTES, "detalhe_exame")),
        LabPlan("HILAB", hilab_typed, hilab_fixed, _hot(lv.HILAB_ANALYTES, "exame"), count_lines=False),
        LabPlan("HLAGYN", hlagyn_typed, hlagyn_fixed, hlagyn_hot, count_lines=False),
        LabPlan("DBMOL", dbmol_typed, dbmol_fixed, _hot(lv.DBMOL_ANALYTES, "detalhe_exame")),
        LabPlan("TARGET", target_typed, target_fixed, _hot(lv.TARGET_ANALYTES, "detalhe_exame")),
        LabPlan("HPARDINI", hpardini_typed, hpardini_fixed, _hot(lv.HPARDINI_ANALYTES, "pathogen")),
    ]
}


def final(plan: LabPlan, samples: DataFrame, table: DataFrame | None, now: Column) -> DataFrame:
    """The laboratory's table after merging a batch of samples into it."""
    batch = keep_decisive(table, samples) if plan.decisive_merge else samples
    return merge(table, stamp(batch, now))
