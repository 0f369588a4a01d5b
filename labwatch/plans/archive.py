"""The archive of samples processed before the laboratories' own tables begin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labwatch import vocab
from labwatch.functions.ages import clamp_age
from labwatch.functions.convert import to_date, to_rounded_int
from labwatch.functions.keys import prefixed
from labwatch.functions.mapping import lookup_keep, sex_exact
from labwatch.functions.text import normalize_text
from labwatch.operators.collapse import keep_one
from labwatch.operators.filters import not_all_untested
from labwatch.operators.upsert import stamp


def typed(raw: DataFrame) -> DataFrame:
    return raw.select(
        prefixed("HISTORICAL_", F.col("sample_id")).alias("sample_id"),
        "lab_id",
        "test_id",
        "test_kit",
        to_date(F.col("date_testing"), "yyyy-M-d").alias("date_testing"),
        "state_code",
        "patient_id",
        "sex",
        to_rounded_int(F.col("age")).alias("age"),
        *vocab.RESULT_COLUMNS,
        "location",
        "state",
    )


def fixed(rows: DataFrame) -> DataFrame:
    return rows.where(not_all_untested() & (F.col("SC2_test_result") != "Inconclusivo")).withColumns(
        {
            "lab_id": lookup_keep(F.col("lab_id"), vocab.LAB_ID_FIXES),
            "sex": sex_exact(F.col("sex")),
            "age": clamp_age(F.col("age"), high=None),
            "location": normalize_text(F.col("location")),
            "state": normalize_text(F.col("state")),
        }
    )


def final(raw: DataFrame, now: Column) -> DataFrame:
    single = keep_one(fixed(typed(raw)), "sample_id", first=("date_testing",))
    return stamp(single, now).withColumns(
        {"qty_original_lines": F.lit(1).cast("bigint"), "file_name": F.lit(vocab.ARCHIVE_FILE_LABEL)}
    )
