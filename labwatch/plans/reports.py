"""The city report and the headline figures of a release."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labwatch import vocab
from labwatch.functions.dates import epi_week
from labwatch.functions.mapping import lookup_keep
from labwatch.functions.metrics import half_up, thousands_dot
from labwatch.operators.filters import latest
from labwatch.operators.reshape import unpivot_tested
from labwatch.operators.windows import sort_like_postgres
from labwatch.plans.matrices import Source, build_matrix, shared
from labwatch.plans.panel import for_reports
from labwatch.sinks.files import as_text, write_delimited


def city_report(panel: DataFrame, code: int = vocab.RIO_DE_JANEIRO_CODE, city: str = "Rio de Janeiro", state: str = "RJ") -> DataFrame:
    """Results of one city counted by day, kit, age and pathogen, without identities."""
    keys = ["date_testing", "test_kit", "age_group", "location_ibge_code", "pathogen", "result"]
    rows = for_reports(panel).where(F.col("location_ibge_code") == code)
    long = unpivot_tested(rows, ["date_testing", "test_kit", "age_group", "location_ibge_code"])
    return long.groupBy(*keys).agg(F.count("*").alias("quantity")).select(
        "date_testing", "test_kit", "age_group", F.lit(city).alias("location"), F.lit(state).alias("state_code"),
        "location_ibge_code", "pathogen", "result", "quantity",
    )


#: File of the city report, tab-separated (fixed value of its reader).
CITY_FILE = "report_ITpS2Epirio_respat.tsv"


def export_city_report(panel: DataFrame, folder: str, **of: object) -> str:
    """The city report as one tab-separated file, in a fixed order; gives its path."""
    path = f"{folder}/{CITY_FILE}"
    rows = sort_like_postgres(city_report(panel, **of), ("date_testing", "asc"), ("test_kit", "asc"))
    write_delimited(as_text(rows), path, "\t", one_file=True, ordered=True)
    return path


def _measures(wide: DataFrame, week: str) -> DataFrame:
    """The newest week of a published table as (name, value) rows."""
    names = [c for c in wide.columns if c != week]
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), F.col(f"`{n}`").cast("double").alias("value"), F.lit(i).alias("position")) for i, n in enumerate(names)])
    return latest(wide, week).select(F.inline(pairs))


def _ranked(value: Column) -> Column:
    """(value, name) pairs of a few measures in falling order; equal values keep the table's column order."""
    entry = F.struct((-value).alias("key"), F.col("position"), value.alias("value"), F.col("name"))
    return F.array_sort(F.collect_list(entry))


def _spelled(name: Column) -> Column:
    return lookup_keep(F.lower(F.trim(name)), vocab.LABEL_SPELLING)


def _list_text(entries: Column) -> Column:
    return F.transform(entries, lambda e: F.concat(_spelled(e["name"]), F.lit(" ("), half_up(e["value"]).cast("string"), F.lit("%)")))


def indicators(volume: DataFrame, counts: DataFrame, main: DataFrame, others: DataFrame, wide: DataFrame) -> DataFrame:
    """One row of headline values.

    ``volume`` is the weekly volume table, ``counts`` the table of all result
    counts, ``main`` the positives of the four-pathogen panel, ``others`` the
    rates of the other pathogens, ``wide`` the positives of the large panels.
    """
    week = "semana epidemiológica"
    cutoff = volume.agg(F.max("Semana Epidemiológica")).scalar()
    total = counts.agg(F.sum("count")).scalar()
    filled = F.coalesce(F.col("value"), F.lit(0.0))

    def shares(df: DataFrame) -> DataFrame:
        rows = _measures(df, week).withColumn("value", filled)
        ranked = rows.agg(_ranked(F.col("value")).alias("r"), F.sum("value").alias("total"))
        scaled = F.transform("r", lambda e: F.struct(e["name"].alias("name"), F.when(F.col("total") > 0, e["value"] / F.col("total") * 100).otherwise(0.0).alias("value")))
        return ranked.select(scaled.alias("r"))

    tops = shares(main).select(
        *[_spelled(F.col("r")[i]["name"]).alias(f"top_pathogen_{i + 1}_name") for i in range(4)],
        *[half_up(F.col("r")[i]["value"]).alias(f"top_pathogen_{i + 1}_positive_share") for i in range(4)],
    )
    rates = _measures(others, week).where(F.col("value") > 0)
    listed = rates.agg(F.array_join(_list_text(_ranked(F.col("value"))), ", ").alias("others_top_positivities"))
    panel = shares(wide).withColumn("rest", F.filter(F.slice("r", 2, F.greatest(F.size("r") - 1, F.lit(0))), lambda e: half_up(e["value"]) > 0))
    rest = _list_text(F.col("rest"))
    joined = F.when(F.size("rest") > 1, F.concat(F.array_join(F.slice(rest, 1, F.size("rest") - 1), ", "), F.lit(" e "), F.element_at(rest, -1))).otherwise(
        F.array_join(rest, ", ")
    )
    panel_row = panel.select(
        _spelled(F.col("r")[0]["name"]).alias("top_other_pathogen_name"),
        half_up(F.col("r")[0]["value"]).alias("top_other_pathogen_positive_share"),
        joined.alias("other_pathogens_positive_shares"),
    )

    def value(df: DataFrame, column: str) -> Column:
        return df.select(column).scalar().alias(column)

    day = F.col("_cutoff")
    base = tops.withColumn("_cutoff", cutoff)
    return base.select(
        F.date_format(day, "dd/MM/yyyy").alias("lab_data_cutoff_date"),
        thousands_dot(total).alias("total_results_cumulative"),
        epi_week(day).cast("string").alias("lab_data_cutoff_epiweek"),
        *[c for c in tops.columns],
        F.concat(F.dayofmonth(day).cast("string"), F.lit("/"), F.month(day).cast("string")).alias("sivep_data_extraction_date"),
        value(listed, "others_top_positivities"),
        value(panel_row, "top_other_pathogen_name"),
        value(panel_row, "top_other_pathogen_positive_share"),
        value(panel_row, "other_pathogens_positive_shares"),
    )


def headline(src: Source) -> DataFrame:
    """Headline values straight from a source. The five tables share the cubes of one pass."""
    src = shared(replace(src, register=None), ["facts", "lab_facts"])
    return indicators(
        volume=build_matrix("matrix_30_Resp_bar_total_posneg_week_regions", src),
        counts=build_matrix("matrix_ALL_count_by_labid_testkit_pathogen_result", src),
        main=build_matrix("matrix_02_Resp_bar_pos_panel4_week_country_r", src),
        others=build_matrix("matrix_06_Resp_line_posrate_direct_week_country_r", src),
        wide=build_matrix("matrix_07_Resp_bar_pos_panel20PLUS_week_country_r", src),
    )
