"""The national severe-case register: coded columns to one row per (case, kit)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labwatch import labs_vocab as lv
from labwatch.functions.ages import age_by_unit
from labwatch.functions.convert import to_date, to_rounded_int
from labwatch.functions.dates import as_date
from labwatch.functions.keys import sample_key
from labwatch.functions.mapping import sex_exact, state_name
from labwatch.functions.results import any_positive, register_pair
from labwatch.functions.text import normalize_text
from labwatch.operators.collapse import fill_and_keep_one, one_hot
from labwatch.operators.reshape import computed_once, lateral_rows

CARRIED = [
    "test_id", "test_kit", "sex", "age", "location", "state", "date_testing", "date_pri_sin", "patient_id", "file_name",
]


def typed(raw: DataFrame) -> DataFrame:
    """Numbers may read ``3.0`` and are rounded; names are normalised; the criterion may carry a semicolon."""

    def column(name: str) -> Column:
        c = F.col(name)
        if name in lv.REGISTER_DATES:
            return to_date(c, "yyyy-M-d")
        if name in lv.REGISTER_NUMBERS:
            return to_rounded_int(c)
        if name in ("ID_MN_RESI", "SG_UF"):
            return normalize_text(c)
        if name == "CRITERIO":
            return to_rounded_int(F.replace(c, F.lit(";"), F.lit("")))
        return c

    return computed_once(raw, *[column(c).alias(c.lower()) for c in lv.REGISTER_COLUMNS], "file_name")


def results(kind: tuple) -> Column:
    form, *names = kind
    if form == "code":
        return F.col(names[0].lower())
    if form == "any":
        return any_positive(*[F.col(n.lower()) for n in names])
    type_col, outcome_col, wanted = names
    return register_pair(F.col(type_col.lower()), F.col(outcome_col.lower()), wanted)


def fixed(rows: DataFrame, as_of: str | date) -> DataFrame:
    """Cases with a sample and a cause, then one row per kit that has a result."""
    cases = rows.where(
        (F.col("amostra") == 1)
        & (F.col("classi_fin") != 4)
        & F.col("id_mn_resi").isNotNull()
        & (F.col("dt_coleta") <= as_date(as_of))
    )
    long = lateral_rows(
        cases,
        [
            {"test_kit": F.lit(kit), "pathogen": F.lit(pathogen), "result": results(kind)}
            for kit, pathogen, kind in lv.REGISTER_KITS
        ],
    ).where(F.col("result").isNotNull())
    age = age_by_unit(F.col("nu_idade_n"), F.col("tp_idade"))
    sex = sex_exact(F.col("cs_sexo"))
    key = sample_key(F.col("nm_un_inte"), F.col("co_mun_res"), F.col("dt_coleta"), age, sex, F.col("test_kit"))
    return computed_once(
        long,
        key.alias("sample_id"),
        sex.alias("sex"),
        age.alias("age"),
        "co_mun_res",
        F.col("id_mn_resi").alias("location"),
        state_name(F.col("sg_uf")).alias("state"),
        F.col("dt_coleta").alias("date_testing"),
        F.col("dt_sin_pri").alias("date_pri_sin"),
        "test_kit",
        "pathogen",
        "result",
        "file_name",
    )


def wide(raw: DataFrame, as_of: str | date) -> DataFrame:
    hot = one_hot(fixed(typed(raw), as_of), lv.REGISTER_ANALYTES, "pathogen")
    rows = hot.withColumns({"test_id": F.col("sample_id"), "patient_id": F.lit(None).cast("string")})
    return fill_and_keep_one(rows, CARRIED)
