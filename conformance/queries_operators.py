"""Registered queries of the single operators, each beside its checking SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from conformance import frames, oracle_base as ob, oracle_labs, oracle_matrices
from conformance import testbed as tb
from conformance.queries_labs import now
from labwatch import labs_vocab as lv
from labwatch import vocab
from labwatch.functions import ages, convert, dates, keys, mapping, metrics, results, text
from labwatch.operators import collapse, filters, joins, reshape, upsert, windows
from labwatch.plans import archive, facts, matrices, panel, register, reports
from labwatch.plans.labs import LABS
from labwatch.plans.matrices import population
from labwatch.session import checkpoint_dir
from labwatch.sinks import buckets

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

T = f"WITH {tb.DUCK_TESTS}"
C = f"WITH {tb.DUCK_CASES}"
LONG = f"{T}, {ob.LONG}"
HOT = f"{LONG}, {ob.HOT}"
SAMPLES = f"WITH {ob.SAMPLES}"
PANEL = f"WITH {ob.PANEL}"
RES = ", ".join(vocab.RESULT_COLUMNS)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register_(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register_


def col(name: str) -> Column:
    return F.col(name)


# -- positivity --------------------------------------------------------------


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.long_results(spark, sf_dir).withColumn("label", results.result_label(col("result")))


_LABELLED = f"{LONG}, lab AS (SELECT *, CASE result WHEN 1 THEN 'Pos' WHEN 0 THEN 'Neg' WHEN -1 THEN 'NT' END AS label FROM long_rows)"


def _positivity(spark: SparkSession, sf_dir: str, bucket: Column, name: str) -> DataFrame:
    """Counters side by side: one exchange, no unpivot."""
    rows = labelled(spark, sf_dir)
    aggs = []
    for p in ("SC2", "FLUA", "FLUB", "VSR"):
        pos = F.sum(F.when(col("analyte") == p, metrics.is_positive(col("label"))).otherwise(0))
        neg = F.sum(F.when(col("analyte") == p, metrics.is_negative(col("label"))).otherwise(0))
        aggs += [pos.alias(f"{p}_pos"), (pos + neg).alias(f"{p}_tests"), metrics.positivity_rate(pos, neg).alias(f"{p}_rate")]
    return rows.groupBy(bucket.alias(name)).agg(*aggs)


def _positivity_sql(bucket: str, name: str) -> str:
    cols = ", ".join(
        f"CAST(SUM(CASE WHEN analyte = '{p}' THEN pos ELSE 0 END) AS BIGINT) AS {p}_pos, CAST(SUM(CASE WHEN analyte = '{p}' THEN totaltests ELSE 0 END) AS BIGINT) AS {p}_tests, "
        f"MAX(CASE WHEN analyte = '{p}' THEN posrate END) AS {p}_rate"
        for p in ("SC2", "FLUA", "FLUB", "VSR")
    )
    return f"{_LABELLED}, g AS (SELECT {bucket} AS {name}, analyte, {ob.metrics('label')} FROM lab GROUP BY ALL) SELECT {name}, {cols} FROM g GROUP BY {name}"


_WEEK_END = "CAST(date_trunc('week', date_testing + INTERVAL 1 DAY) + INTERVAL 5 DAY AS DATE)"


@query("positivity_by_week", _positivity_sql(_WEEK_END, "epiweek_enddate"))
def positivity_by_week(spark, sf_dir):
    return _positivity(spark, sf_dir, dates.week_end(col("date_testing")), "epiweek_enddate")


@query("positivity_by_month", _positivity_sql("strftime(date_testing, '%Y-%m')", "month"))
def positivity_by_month(spark, sf_dir):
    return _positivity(spark, sf_dir, dates.year_month(col("date_testing")), "month")


# -- text --------------------------------------------------------------------

_NORM_TEXT = ob.norm("text")


@query("normalize_text", f"SELECT doc_id, {_NORM_TEXT} AS normalized FROM documents")
def normalize_text(spark, sf_dir):
    return tb.table(spark, sf_dir, "documents").select("doc_id", text.normalize_text(col("text")).alias("normalized"))


@query("strip_nonword", f"SELECT doc_id, regexp_replace({_NORM_TEXT}, '[^\\w\\s]', '', 'g') AS stripped FROM documents")
def strip_nonword(spark, sf_dir):
    return tb.table(spark, sf_dir, "documents").select("doc_id", text.strip_nonword(text.normalize_text(col("text"))).alias("stripped"))


@query("squeeze_text", "SELECT doc_id, regexp_replace(regexp_replace(text, '[.:]', '', 'g'), '\\s+', ' ', 'g') AS squeezed FROM documents")
def squeeze_text(spark, sf_dir):
    return tb.table(spark, sf_dir, "documents").select("doc_id", text.squeeze(col("text")).alias("squeezed"))


@query("url_words", "SELECT page_id, regexp_replace(upper(url), '[^\\w\\s]', '', 'g') AS words FROM pages")
def url_words(spark, sf_dir):
    return tb.table(spark, sf_dir, "pages").select("page_id", text.strip_nonword(text.normalize_text(col("url"))).alias("words"))


@query("remove_terms", f"{T} SELECT l_orderkey, l_linenumber, l_partkey, replace(replace(concat(CASE l_linenumber % 3 WHEN 0 THEN 'INFERIOR A ' WHEN 1 THEN 'SUPERIOR A ' ELSE '' END, CAST(l_partkey AS VARCHAR)), 'INFERIOR A ', ''), 'SUPERIOR A ', '') AS bare FROM tests")
def remove_terms(spark, sf_dir):
    word = F.when(col("l_linenumber") % 3 == 0, "INFERIOR A ").when(col("l_linenumber") % 3 == 1, "SUPERIOR A ").otherwise("")
    bare = text.remove_terms(F.concat(word, col("l_partkey").cast("string")), lv.DBMOL_BOUND_TERMS)
    return tb.tests(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", bare.alias("bare"))


# -- keys --------------------------------------------------------------------


@query("sample_key", f"{T} SELECT l_orderkey, l_linenumber, l_partkey, md5(concat(l_orderkey, nullif(l_linenumber, 3), dt, nullif(l_returnflag, 'R'))) AS sample_id FROM tests")
def sample_key(spark, sf_dir):
    key = keys.sample_key(col("l_orderkey"), F.nullif(col("l_linenumber"), F.lit(3)), col("dt"), F.nullif(col("l_returnflag"), F.lit("R")))
    return tb.tests(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", key.alias("sample_id"))


@query("panel_key", f"{T} SELECT l_orderkey, l_linenumber, l_partkey, md5(concat(l_orderkey, o_orderpriority, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'panel' ELSE CAST(l_linenumber AS VARCHAR) END)) AS sample_id FROM tests")
def panel_key(spark, sf_dir):
    part = F.when(col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "panel").otherwise(col("l_linenumber").cast("string"))
    key = keys.sample_key(col("l_orderkey"), col("o_orderpriority"), part)
    return tb.tests(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", key.alias("sample_id"))


@query("prefix_key", "SELECT o_orderkey, 'HISTORICAL_' || nullif(o_orderpriority, '5-LOW') AS key FROM orders")
def prefix_key(spark, sf_dir):
    return tb.table(spark, sf_dir, "orders").select("o_orderkey", keys.prefixed("HISTORICAL_", F.nullif(col("o_orderpriority"), F.lit("5-LOW"))).alias("key"))


# -- ages --------------------------------------------------------------------

_AGE_FORMS = "CASE p_partkey % 7 WHEN 0 THEN CAST(p_size AS STRING) WHEN 1 THEN concat(CAST(p_size AS STRING), 'A10M') WHEN 2 THEN concat(CAST(p_size AS STRING), 'M') WHEN 3 THEN concat(CAST(p_size AS STRING), 'D') WHEN 4 THEN NULL WHEN 5 THEN '' ELSE 'idoso' END"


@query("age_parser", f"SELECT p_partkey, {oracle_labs.age_text('a', '-1')} AS age, {oracle_labs.age_text('a', 'NULL')} AS age_or_null FROM (SELECT p_partkey, {_AGE_FORMS} AS a FROM part)")
def age_parser(spark, sf_dir):
    a = F.expr(_AGE_FORMS)
    return tb.table(spark, sf_dir, "part").select("p_partkey", ages.parse_age_text(a, -1).alias("age"), ages.parse_age_text(a).alias("age_or_null"))


_BORN = "dt - CAST(p_size * 900 + o_orderkey % 365 AS INT)"


@query("age_years", f"{T} SELECT l_orderkey, l_linenumber, l_partkey, {oracle_labs.years('dt', 'born')} AS age FROM (SELECT *, {_BORN} AS born FROM tests)")
def age_years(spark, sf_dir):
    rows = tb.tests(spark, sf_dir).withColumn("born", F.expr(_BORN))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", ages.completed_years(col("dt"), col("born")).alias("age"))


@query("age_clamp", f"{T} SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN a > 120 OR a < 0 THEN NULL ELSE a END AS age, CASE WHEN a < 0 THEN NULL ELSE a END AS age_low, CASE WHEN u IN (1, 2) THEN 0 WHEN u = 3 THEN a END AS age_unit FROM (SELECT *, {tb.AGE} AS a, o_orderkey % 5 AS u FROM tests)")
def age_clamp(spark, sf_dir):
    rows = tb.tests(spark, sf_dir).withColumns({"a": F.expr(tb.AGE), "u": col("o_orderkey") % 5})
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", ages.clamp_age(col("a")).alias("age"), ages.clamp_age(col("a"), high=None).alias("age_low"),
        ages.age_by_unit(col("a"), col("u")).alias("age_unit"),
    )


# -- vocabularies ------------------------------------------------------------

_CODE = tb.pick("c_nationkey", [*tb.STATE_CODES[:20], "XX", None, "SP", "sp", ""])
_LAB = tb.pick("o_orderkey % 4", ["DB Mol", "HLAGyn", "Sabin", None])
_REGION = tb.pick("o_orderkey % 6", [*vocab.REGION_LABELS, "OUTRA"])


@query("code_maps", f"{tb.most_nations(C)} SELECT o_orderkey, {ob.state_case('code')} AS state, COALESCE({ob.state_case('code')}, 'NOT REPORTED') AS state_or_label, {ob.case_map('lab', vocab.LAB_ID_FIXES, 'lab')} AS lab_id, {ob.case_map('reg', vocab.REGION_LABELS)} AS region FROM (SELECT o_orderkey, {tb.duck(_CODE)} AS code, {tb.duck(_LAB)} AS lab, {tb.duck(_REGION)} AS reg FROM cases)")
def code_maps(spark, sf_dir):
    rows = tb.cases(spark, sf_dir, tb.most_nations).select("o_orderkey", F.expr(_CODE).alias("code"), F.expr(_LAB).alias("lab"), F.expr(_REGION).alias("reg"))
    return rows.select(
        "o_orderkey", mapping.state_name(col("code")).alias("state"), mapping.state_name(col("code"), "NOT REPORTED").alias("state_or_label"),
        mapping.lookup_keep(col("lab"), vocab.LAB_ID_FIXES).alias("lab_id"), mapping.region_label(col("reg")).alias("region"),
    )


_EXAM = tb.pick("o_orderkey % 5", ["PCR COVID19 EXPRESS", "PAINEL MOLECULAR PATOGENOS RESPIRATORIOS II", "Inativo PMPR", "TX PCR COVID19", None])
_EINSTEIN_KIT = ob.case_map("e", lv.EINSTEIN_KITS, "CASE WHEN e ILIKE 'PAINEL MOLECULAR PATOGENOS RESPIRATORIOS%' THEN 'test_4' ELSE 'UNKNOWN' END")
_SEX_WORD = tb.pick("o_orderkey % 6", ["F", "feminino", "M", "Masc", "I", None])


@query("kit_and_sex_maps", f"{C} SELECT o_orderkey, {_EINSTEIN_KIT} AS test_kit, CASE WHEN s ILIKE 'F%' THEN 'F' WHEN s ILIKE 'M%' THEN 'M' END AS sex, CASE s WHEN 'F' THEN 'F' WHEN 'M' THEN 'M' END AS sex_exact FROM (SELECT o_orderkey, {tb.duck(_EXAM)} AS e, {tb.duck(_SEX_WORD)} AS s FROM cases)")
def kit_and_sex_maps(spark, sf_dir):
    rows = tb.cases(spark, sf_dir).select("o_orderkey", F.expr(_EXAM).alias("e"), F.expr(_SEX_WORD).alias("s"))
    kit = F.coalesce(mapping.lookup(col("e"), lv.EINSTEIN_KITS), mapping.by_prefix(col("e"), lv.EINSTEIN_KIT_PREFIXES), F.lit("UNKNOWN"))
    return rows.select("o_orderkey", kit.alias("test_kit"), mapping.sex_by_prefix(col("s")).alias("sex"), mapping.sex_exact(col("s")).alias("sex_exact"))


_WORD = tb.pick("l_suppkey % 6", ["POSITIVO", "NAO DETECTADO", "DETECTADO (POSITIVO)", "INCONCLUSIVO", "ILEGIVEL", None])


@query("result_vocab", f"{T} SELECT l_orderkey, l_linenumber, l_partkey, {ob.case_map('w', lv.FLEURY_RESULTS, '-2')} AS code, CASE w WHEN 'POSITIVO' THEN 1 WHEN 'NEGATIVO' THEN 0 END AS strict_code FROM (SELECT *, {tb.duck(_WORD)} AS w FROM tests)")
def result_vocab(spark, sf_dir):
    rows = tb.tests(spark, sf_dir).withColumn("w", F.expr(_WORD))
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", mapping.lookup(col("w"), lv.FLEURY_RESULTS, -2).alias("code"),
        mapping.lookup(col("w"), lv.HPARDINI_RESULTS).alias("strict_code"),
    )


# -- thresholds --------------------------------------------------------------

_READING = "CASE l_linenumber % 5 WHEN 0 THEN concat('INFERIOR A ', CAST(CAST(l_quantity AS INT) AS STRING)) WHEN 1 THEN concat(CAST(CAST(l_quantity AS INT) AS STRING), '.5') WHEN 2 THEN 'REAGENTE' WHEN 3 THEN CAST(CAST(l_quantity AS INT) AS STRING) ELSE NULL END"


@query("threshold_two_way", f"{T} SELECT l_orderkey, l_linenumber, l_partkey, {oracle_labs.two('r', 25.0)} AS code FROM (SELECT *, {_READING} AS r FROM tests)")
def threshold_two_way(spark, sf_dir):
    return tb.tests(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", results.two_way(F.expr(_READING), 25.0).alias("code"))


@query("threshold_three_way", f"{T} SELECT l_orderkey, l_linenumber, l_partkey, {oracle_labs.three('r', 10.0, 25.5)} AS code FROM (SELECT *, {_READING} AS r FROM tests)")
def threshold_three_way(spark, sf_dir):
    return tb.tests(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", results.three_way(F.expr(_READING), 10.0, 25.5).alias("code"))


_DISPATCH_SQL = (
    "SELECT sample_id, codigo_exame, result AS code, count(*) AS n FROM (SELECT md5(concat(test_id, exame, CASE WHEN codigo IN "
    f"{ob.in_list(lv.DBMOL_PANEL_CODES)} THEN codigo ELSE detalhe_exame END)) AS sample_id, codigo AS codigo_exame, {oracle_labs._DB_RESULT} AS result FROM typed "
    f"WHERE codigo IN {ob.in_list(lv.DBMOL_KEPT_CODES)} AND detalhe_exame NOT IN {ob.in_list(lv.DBMOL_DROPPED_PARAMETERS)} AND result NOT IN {ob.in_list(lv.DBMOL_DROPPED_RESULTS)}) "
    "WHERE code != -3 GROUP BY ALL"
)
_DB_TYPED = oracle_labs.LONG["DBMOL"].split("long_ AS")[0].rstrip().rstrip(",")


@query("threshold_dispatch", f"{T}, raw AS ({tb.duck(tb.RAW['DBMOL'])}), {_DB_TYPED} {_DISPATCH_SQL}")
def threshold_dispatch(spark, sf_dir):
    """Exam-dependent reading of results over the laboratory that mixes words and numbers."""
    long = LABS["DBMOL"].long(tb.raw(spark, sf_dir, "DBMOL"))
    return long.groupBy("sample_id", "codigo_exame", col("result").alias("code")).agg(F.count("*").alias("n"))


# -- register codes, row maxima, labels --------------------------------------

_REG_FINAL = f"WITH {ob.REGISTER_LONG}"


@query("lateral_kits", f"{_REG_FINAL} SELECT * FROM reg_long")
def lateral_kits(spark, sf_dir):
    """Coded register columns to one row per kit with a result."""
    return register.fixed(register.typed(tb.raw_register(spark, sf_dir)), tb.AS_OF)


@query("greatest_group", f"{T} SELECT l_orderkey, l_linenumber, l_partkey, greatest(nullif(l_linenumber, 3), CAST(l_suppkey % 5 AS INTEGER), nullif(CAST(l_partkey % 9 AS INTEGER), 8)) AS highest FROM tests")
def greatest_group(spark, sf_dir):
    highest = results.row_max(
        F.nullif(col("l_linenumber"), F.lit(3)), (col("l_suppkey") % 5).cast("int"), F.nullif((col("l_partkey") % 9).cast("int"), F.lit(8))
    )
    return tb.tests(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", highest.alias("highest"))


@query("null_labels", f"{tb.most_nations(C)} SELECT o_orderkey, COALESCE(nullif(o_orderstatus, 'P'), 'NOT REPORTED') AS status, CAST(o_custkey AS DOUBLE) / nullif(nullif(c_nationkey, 24), 0) * 100000 AS per_100k FROM cases")
def null_labels(spark, sf_dir):
    return tb.cases(spark, sf_dir, tb.most_nations).select(
        "o_orderkey", mapping.or_label(F.nullif(col("o_orderstatus"), F.lit("P"))).alias("status"),
        metrics.per_100k(col("o_custkey"), F.nullif(col("c_nationkey"), F.lit(24))).alias("per_100k"),
    )


# -- calendar ----------------------------------------------------------------

_W = "CAST(date_trunc('week', dt + INTERVAL 1 DAY) - INTERVAL 1 DAY AS DATE)"
_Y = f"year({_W} + INTERVAL 3 DAY)"
_MONTHS = " ".join(f"WHEN w >= {a} THEN '{b}'" for a, b in reversed(vocab.MONTH_LABEL_STARTS))
_CAL = f"{C}, {ob.EPIWEEKS}, cal AS (SELECT c.o_orderkey, c.dt, e.start_date, e.end_date, e.week_num AS w, CAST(e.year AS INTEGER) AS y FROM cases c LEFT JOIN epiweeks e ON c.dt BETWEEN e.start_date AND e.end_date)"


@query("epiweek_fields", f"{_CAL} SELECT o_orderkey, start_date, end_date, w AS week_num, y AS epi_year, strftime(dt, '%Y-%m') AS month, concat(year(dt), ' - ', quarter(dt), 'º Trimestre') AS quarter, concat('SE', lpad(CAST(w AS VARCHAR), 2, '0'), ' - ', CASE {_MONTHS} END) AS label FROM cal")
def epiweek_fields(spark, sf_dir):
    d = col("dt")
    return tb.cases(spark, sf_dir).select(
        "o_orderkey", dates.week_start(d).alias("start_date"), dates.week_end(d).alias("end_date"), dates.epi_week(d).alias("week_num"),
        dates.epi_year(d).alias("epi_year"), dates.year_month(d).alias("month"), dates.quarter_label(d).alias("quarter"),
        dates.week_label(dates.epi_week(d)).alias("label"),
    )


@query("epiweek_format", f"{_CAL} SELECT o_orderkey, concat('SE', lpad(CAST(w AS VARCHAR), 2, '0'), '.', y, ' ', start_date, '_', end_date, ' ', strftime(end_date, '%d/%m/%Y')) AS label, CAST(w AS VARCHAR) AS num FROM cal")
def epiweek_format(spark, sf_dir):
    label = dates.format_week(col("dt"), "SE{EPINUM}.{EPIYEAR} {EPISTART}_{EPIEND} %d/%m/%Y", zfill=2)
    return tb.cases(spark, sf_dir).select("o_orderkey", label.alias("label"), dates.format_week(col("dt")).alias("num"))


@query("audit_clock", f"SELECT o_orderkey, {ob.NOW_LOCAL} AS created_at, {ob.NOW_LOCAL} AS updated_at FROM orders")
def audit_clock(spark, sf_dir):
    return upsert.stamp(tb.table(spark, sf_dir, "orders").select("o_orderkey"), now())


@query("rounding_labels", "SELECT o_orderkey, CAST(floor(o_totalprice + 0.5) AS INTEGER) AS half_up, replace(format('{:,}', o_custkey * 1000), ',', '.') AS dotted, CAST(round(CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(38, 6))) AS INTEGER) AS rounded FROM orders")
def rounding_labels(spark, sf_dir):
    price = col("o_totalprice")
    return tb.table(spark, sf_dir, "orders").select(
        "o_orderkey", metrics.half_up(price).alias("half_up"), metrics.thousands_dot(col("o_custkey") * 1000).alias("dotted"),
        convert.to_rounded_int(price.cast("decimal(18,4)").cast("string")).alias("rounded"),
    )


# -- projections -------------------------------------------------------------

_TEXTS = "concat('0', CAST(o_orderkey AS STRING)) AS id, concat(CAST(o_custkey AS STRING), '.6;') AS num, CAST(dt AS STRING) AS iso, concat(substr(CAST(dt AS STRING), 9, 2), '/', substr(CAST(dt AS STRING), 6, 2), '/', substr(CAST(dt AS STRING), 1, 4), ' 10:00') AS dmy, CASE WHEN o_orderkey % 3 = 0 THEN '31/02/2024' WHEN o_orderkey % 3 = 1 THEN CAST(dt AS STRING) ELSE concat(substr(CAST(dt AS STRING), 9, 2), '/', substr(CAST(dt AS STRING), 6, 2), '/', substr(CAST(dt AS STRING), 1, 4)) END AS mixed"


@query("typed_projection", f"{C}, x AS (SELECT {_TEXTS} FROM cases) SELECT CAST(CAST(id AS BIGINT) AS VARCHAR) AS id, CAST(round(CAST(replace(num, ';', '') AS DECIMAL(18, 2))) AS INTEGER) AS num, CAST(iso AS DATE) AS iso, CAST(strptime(substr(dmy, 1, 10), '%d/%m/%Y') AS DATE) AS dmy, COALESCE(CAST(try_strptime(mixed, '%d/%m/%Y') AS DATE), CAST(try_strptime(mixed, '%Y-%m-%d') AS DATE)) AS mixed FROM x")
def typed_projection(spark, sf_dir):
    rows = spark.sql(f"SELECT {_TEXTS} FROM {{cases}}", cases=tb.cases(spark, sf_dir))
    return rows.select(
        convert.integer_text(col("id")).alias("id"), convert.to_rounded_int(F.replace(col("num"), F.lit(";"), F.lit(""))).alias("num"),
        convert.to_date(col("iso"), "yyyy-M-d").alias("iso"), convert.to_date(col("dmy"), "d/M/yyyy").alias("dmy"),
        convert.to_mixed_date(col("mixed"), "d/M/yyyy", "yyyy-M-d").alias("mixed"),
    )


@query("distinct_projection", f"{T} SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag, dt FROM tests")
def distinct_projection(spark, sf_dir):
    return tb.tests(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_returnflag", "dt").distinct()


@query("drop_columns", f"{PANEL} SELECT * EXCLUDE (sample_id, test_id, lab_id, file_name, patient_id, qty_original_lines) FROM panel")
def drop_columns(spark, sf_dir):
    return panel.for_reports(frames.full_panel(spark, sf_dir))


# -- filters -----------------------------------------------------------------

_NULLED = "SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS pr, nullif(o_orderstatus, 'P') AS st FROM orders"


def nulled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.spark_table(spark, sf_dir, _NULLED.replace("FROM orders", "FROM {orders}"))


@query("filter_lists_nulls", f"SELECT * FROM ({_NULLED}) WHERE pr NOT IN ('1-URGENT', '2-HIGH') AND st IS NOT NULL")
def filter_lists_nulls(spark, sf_dir):
    return nulled(spark, sf_dir).where(~col("pr").isin("1-URGENT", "2-HIGH") & col("st").isNotNull())


@query("filter_prefix", f"SELECT * FROM ({_NULLED}) WHERE pr ILIKE '3-med%' OR NOT (pr ILIKE '4-NOT%')")
def filter_prefix(spark, sf_dir):
    return nulled(spark, sf_dir).where(text.starts_with(col("pr"), "3-med") | ~text.starts_with(col("pr"), "4-NOT"))


@query("filter_any_informative", f"SELECT * FROM ({_NULLED}) WHERE (pr NOT IN ('3-MEDIUM', '4-NOT SPECIFIED') AND pr IS NOT NULL) OR (st NOT IN ('3-MEDIUM', '4-NOT SPECIFIED') AND st IS NOT NULL)")
def filter_any_informative(spark, sf_dir):
    return nulled(spark, sf_dir).where(filters.any_informative(["pr", "st"], ["3-MEDIUM", "4-NOT SPECIFIED"]))


_ALL_NT = " AND ".join(f"{c} = 'NT'" for c in vocab.RESULT_COLUMNS)


@query("filter_not_all_untested", f"{SAMPLES} SELECT * FROM samples WHERE NOT ({_ALL_NT})")
def filter_not_all_untested(spark, sf_dir):
    return frames.samples(spark, sf_dir).where(filters.not_all_untested())


@query("filter_relative_dates", f"{C} SELECT o_orderkey, dt FROM cases WHERE dt <= {ob.AS_OF} AND dt < date_trunc('quarter', {ob.AS_OF}) AND dt > {ob.AS_OF} - 400")
def filter_relative_dates(spark, sf_dir):
    as_of = dates.as_date(tb.AS_OF)
    return tb.cases(spark, sf_dir).select("o_orderkey", "dt").where(
        (col("dt") <= as_of) & (col("dt") < F.trunc(as_of, "quarter")) & (col("dt") > F.date_sub(as_of, 400))
    )


@query("filter_cutover", f"{C} SELECT o_orderkey, dt FROM cases WHERE dt >= DATE '2021-10-01' AND dt < DATE '2024-01-01'")
def filter_cutover(spark, sf_dir):
    return tb.cases(spark, sf_dir).select("o_orderkey", "dt").where(filters.between_days("dt", from_=vocab.PANEL_START, before=vocab.LAB_CUTOVER))


_ROUTE = "CASE WHEN SC2_test_result IN ('Pos', 'Neg') THEN test_kit IN ('test_4', 'covid_pcr') WHEN FLUA_test_result IN ('Pos', 'Neg') THEN test_kit IN ('flu_pcr', 'test_24') ELSE FALSE END"


@query("filter_routing", f"{SAMPLES} SELECT sample_id, test_kit, u.result, u.pathogen FROM samples r CROSS JOIN LATERAL (VALUES {ob._TUPLES}) AS u(result, pathogen) WHERE {_ROUTE}")
def filter_routing(spark, sf_dir):
    kept = frames.samples(spark, sf_dir).where(
        filters.routed(
            [
                (filters.is_tested("SC2_test_result"), col("test_kit").isin("test_4", "covid_pcr")),
                (filters.is_tested("FLUA_test_result"), col("test_kit").isin("flu_pcr", "test_24")),
            ]
        )
    )
    return reshape.unpivot_results(kept, ["sample_id", "test_kit"])


@query("filter_exclusions", f"{LONG} SELECT * FROM long_rows WHERE test_id NOT IN ('638', '603') AND NOT (date_testing = DATE '2024-05-10' AND age = 84)")
def filter_exclusions(spark, sf_dir):
    return tb.long_results(spark, sf_dir).where(
        ~col("test_id").isin("638", "603") & ~((col("date_testing") == dates.as_date("2024-05-10")) & (col("age") == 84))
    )


# -- collapse ----------------------------------------------------------------

_HOT_ROWS = f"{HOT} SELECT sample_id, test_id, analyte, result, {RES} FROM hot"


@query("one_hot_pivot", _HOT_ROWS)
def one_hot_pivot(spark, sf_dir):
    return frames.hot(spark, sf_dir).select("sample_id", "test_id", "analyte", "result", *vocab.RESULT_COLUMNS)


_FILLED = ", ".join(f"CASE MAX({c}) OVER w WHEN 1 THEN 'Pos' WHEN 0 THEN 'Neg' WHEN -1 THEN 'NT' END AS {c}" for c in vocab.RESULT_COLUMNS)


@query("fill_results", f"{HOT} SELECT sample_id, file_name, age, {_FILLED}, COUNT(*) OVER w AS qty_original_lines FROM hot WINDOW w AS (PARTITION BY sample_id)")
def fill_results(spark, sf_dir):
    return collapse.fill(frames.hot(spark, sf_dir).select("sample_id", "file_name", "age", *vocab.RESULT_COLUMNS))


@query("samples", f"{SAMPLES} SELECT * FROM samples")
def samples(spark, sf_dir):
    return frames.samples(spark, sf_dir)


_LONG_COLS = ["test_id", "test_kit", "lab_id", "sex", "age", "location", "state", "date_testing", "patient_id", "file_name", "analyte", "result"]


@query("dedup_first", f"{LONG} SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY test_id ORDER BY {ob.tie_break([c for c in _LONG_COLS if c != 'test_id'])}) AS rn FROM long_rows) WHERE rn = 1")
def dedup_first(spark, sf_dir):
    return collapse.keep_one(tb.long_results(spark, sf_dir), "test_id")


@query("early_dedup", f"{LONG} SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY test_id, analyte ORDER BY {ob.tie_break([c for c in _LONG_COLS if c not in ('test_id', 'analyte')])}) AS rn FROM long_rows) WHERE rn = 1")
def early_dedup(spark, sf_dir):
    return collapse.keep_one(tb.long_results(spark, sf_dir), ["test_id", "analyte"])


# -- reshape -----------------------------------------------------------------

_FLEURY_SPLIT = f"{T}, raw AS ({tb.duck(tb.RAW['FLEURY'])}), {oracle_labs.LONG['FLEURY']} SELECT sample_id, test_id, pathogen, result, file_name, age FROM long_"


@query("explode_rule", _FLEURY_SPLIT)
def explode_rule(spark, sf_dir):
    """One combined rapid-test row to two, without duplicates."""
    return LABS["FLEURY"].long(tb.raw(spark, sf_dir, "FLEURY")).select("sample_id", "test_id", "pathogen", "result", "file_name", "age")


@query("unpivot_keep_wide", f"WITH {ob.UNPIVOTED} SELECT * FROM up")
def unpivot_keep_wide(spark, sf_dir):
    return reshape.unpivot_results(facts.rows(frames.full_panel(spark, sf_dir), tb.AS_OF))


@query("unpivot_register", f"WITH {ob.DIMENSIONS}, {ob.REGISTER}, {ob.REGISTER_ROWS} SELECT * FROM reg_up")
def unpivot_register(spark, sf_dir):
    dims = frames.dimensions(spark, sf_dir)
    rows = facts.register_rows(frames.register_samples(spark, sf_dir), dims.macroregions, dims.municipalities, dims.age_groups, tb.AS_OF)
    return reshape.unpivot_results(rows)


@query("unpivot_drop_untested", f"{SAMPLES} SELECT sample_id, test_kit, u.result, u.pathogen FROM samples r CROSS JOIN LATERAL (VALUES {ob._TUPLES}) AS u(result, pathogen) WHERE u.result <> 'NT'")
def unpivot_drop_untested(spark, sf_dir):
    return reshape.unpivot_tested(frames.samples(spark, sf_dir), ["sample_id", "test_kit"])


_KIT_PIVOT = "SELECT test_kit, CAST(SUM(CASE WHEN analyte = 'SC2' THEN result ELSE 0 END) AS BIGINT) AS sc2, CAST(SUM(CASE WHEN analyte = 'VSR' THEN result ELSE 0 END) AS BIGINT) AS vsr"


@query("conditional_pivot", f"{LONG} {_KIT_PIVOT}, MAX(CASE WHEN analyte = 'SC2' THEN age END) AS sc2_age FROM long_rows GROUP BY test_kit")
def conditional_pivot(spark, sf_dir):
    rows = tb.long_results(spark, sf_dir)
    sums = reshape.pivot_sum(rows, ["test_kit"], "analyte", col("result"), {"SC2": "sc2", "VSR": "vsr"})
    return sums.join(reshape.pivot_max(rows, ["test_kit"], "analyte", col("age"), {"SC2": "sc2_age"}), "test_kit")


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_SEG_SQL = ", ".join(f"CAST(SUM(CASE WHEN c_mktsegment = '{s}' THEN 1 ELSE 0 END) AS BIGINT) AS \"{s} (SRAG)\"" for s in _SEGMENTS)


@query("dynamic_pivot", f"{C} SELECT c_nationkey, {_SEG_SQL} FROM cases GROUP BY c_nationkey")
def dynamic_pivot(spark, sf_dir):
    rows = tb.cases(spark, sf_dir)
    found = reshape.distinct_values(rows, "c_mktsegment")
    return reshape.pivot_sum(rows, ["c_nationkey"], "c_mktsegment", F.lit(1), {s: f"{s} (SRAG)" for s in found})


_MONTHLY = "SELECT strftime(date_testing, '%Y-%m') AS month, lab_id, test_kit, COUNT(*) AS n FROM long_rows GROUP BY ALL"


@query("grid_fill", f"{LONG}, g AS ({_MONTHLY}) SELECT m.month, k.lab_id, k.test_kit, COALESCE(g.n, 0) AS n FROM (SELECT DISTINCT strftime(date_testing, '%Y-%m') AS month FROM long_rows) m CROSS JOIN (SELECT DISTINCT lab_id, test_kit FROM g) k LEFT JOIN g ON g.month = m.month AND g.test_kit = k.test_kit AND g.lab_id = k.lab_id")
def grid_fill(spark, sf_dir):
    rows = tb.long_results(spark, sf_dir).withColumn("month", dates.year_month(col("date_testing")))
    cells = rows.groupBy("month", "lab_id", "test_kit").agg(F.count("*").alias("n"))
    return reshape.complete_buckets(cells, ["lab_id", "test_kit"], "month", reshape.calendar_values(rows, "month"), fill=0)


# -- joins -------------------------------------------------------------------


@query("join_method", f"{LONG}, {ob.METHODS} SELECT l.test_id, l.test_kit, l.analyte, m.test_method FROM long_rows l LEFT JOIN methods m ON l.test_kit = m.test_kit")
def join_method(spark, sf_dir):
    table = joins.literal_table(spark, ["test_kit", "test_method"], list(vocab.TEST_METHODS.items()))
    return joins.attach_method(tb.long_results(spark, sf_dir).select("test_id", "test_kit", "analyte"), table)


@query("join_band_age", f"{LONG}, {ob.AGE_GROUPS} SELECT l.test_id, l.analyte, l.age, g.age_group FROM long_rows l LEFT JOIN age_groups g ON l.age >= g.min_age AND l.age <= g.max_age")
def join_band_age(spark, sf_dir):
    table = joins.literal_table(spark, ["age_group", "min_age", "max_age"], vocab.AGE_BANDS)
    return joins.attach_band(tb.long_results(spark, sf_dir).select("test_id", "analyte", "age"), table)


@query("join_epiweek", f"{LONG}, {ob.EPIWEEKS} SELECT l.test_id, l.analyte, l.date_testing, w.end_date, w.week_num FROM long_rows l LEFT JOIN epiweeks w ON l.date_testing >= w.start_date AND l.date_testing <= w.end_date")
def join_epiweek(spark, sf_dir):
    rows = tb.long_results(spark, sf_dir).select("test_id", "analyte", "date_testing")
    weeks = joins.calendar(spark).select("start_date", "end_date", "week_num")
    return joins.attach_calendar(rows, weeks, "date_testing").drop("start_date")


@query("fix_names", f"{PANEL} SELECT sample_id, location, state FROM fixed")
def fix_names(spark, sf_dir):
    rows = panel_rows(spark, sf_dir).select("sample_id", "location", "state")
    states = joins.literal_table(spark, ["source_state", "target_state"], list(vocab.STATE_FIXES.items()))
    places = joins.literal_table(
        spark, ["source_location", "source_state", "target_location"], [(a, b, c) for (a, b), c in vocab.LOCATION_FIXES.items()]
    )
    return joins.fix_places(rows, states, places)


def panel_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.samples(spark, sf_dir).where(filters.between_days("date_testing", from_=vocab.PANEL_START))




@query("panel", f"{PANEL} SELECT * FROM panel")
def full_panel(spark, sf_dir):
    return frames.full_panel(spark, sf_dir)


@query("join_geo", f"WITH {tb.DUCK_CASES}, {tb.DUCK_GEOGRAPHY}, x AS (SELECT o_orderkey, {ob.norm(tb.PLACE)} AS location, {ob.state_case(tb.duck(tb.STATE_CODE))} AS state FROM cases) SELECT o_orderkey, m.NM_MUN AS location, m.CD_MUN AS location_ibge_code, r.CO_MACSAUD AS macroregion_code FROM x LEFT JOIN municipalities m ON x.location LIKE m.NM_MUN_NORM AND x.state LIKE m.NM_UF_NORM LEFT JOIN macroregions r ON m.CD_UF = r.CO_UF AND 'BR' || m.CD_MUN = r.ADM2_PCODE")
def join_geo(spark, sf_dir):
    rows = tb.cases(spark, sf_dir).select(
        "o_orderkey", text.normalize_text(F.expr(tb.PLACE)).alias("location"), mapping.state_name(F.expr(tb.STATE_CODE)).alias("state")
    )
    dims = frames.dimensions(spark, sf_dir)
    return joins.attach_geography(rows, dims.places).select("o_orderkey", "location", "location_ibge_code", "macroregion_code")


@query("join_population", f"WITH {tb.most_nations(ob.PANEL)}, pop AS (SELECT CAST(regexp_replace(ADM2_PCODE, '^BR', '') AS INTEGER) AS code, Populacao AS people FROM macroregions WHERE ADM2_PCODE ILIKE 'BR%') SELECT location_ibge_code, people, COUNT(*) AS samples FROM panel LEFT JOIN pop ON location_ibge_code = code GROUP BY ALL")
def join_population(spark, sf_dir):
    """Counts per city first, population after: the join sees cities, not samples."""
    per_city = frames.full_panel(spark, sf_dir, tb.most_nations).groupBy("location_ibge_code").agg(F.count("*").alias("samples"))
    return per_city.join(population(tb.macroregions(spark, sf_dir), by_city=True), "location_ibge_code", "left").select(
        "location_ibge_code", "people", "samples"
    )


@query("scalar_totals", f"{LONG}, g AS (SELECT test_kit, COUNT(*) AS n FROM long_rows GROUP BY ALL) SELECT test_kit, n, CAST(n AS DOUBLE) / (SELECT SUM(n) FROM g) AS share, (SELECT MAX(date_testing) FROM long_rows) AS newest FROM g")
def scalar_totals(spark, sf_dir):
    rows = tb.long_results(spark, sf_dir)
    counts = rows.groupBy("test_kit").agg(F.count("*").alias("n"))
    total, newest = counts.agg(F.sum("n")).scalar(), rows.agg(F.max("date_testing")).scalar()
    return counts.select("test_kit", "n", (col("n").cast("double") / total).alias("share"), newest.alias("newest"))


_OUTER = "WITH a AS (SELECT CAST(l_shipdate AS DATE) AS dt, COUNT(*) AS tests FROM lineitem GROUP BY ALL), b AS (SELECT CAST(o_orderdate AS DATE) AS dt, COUNT(*) AS cases FROM orders GROUP BY ALL)"


@query("full_outer_sources", f"{_OUTER} SELECT COALESCE(a.dt, b.dt) AS dt, a.tests, b.cases FROM a FULL OUTER JOIN b ON a.dt = b.dt")
def full_outer_sources(spark, sf_dir):
    """Days of one source or of both: shipping goes on after the last order."""
    a = tb.table(spark, sf_dir, "lineitem").groupBy(col("l_shipdate").cast("date").alias("dt")).agg(F.count("*").alias("tests"))
    b = tb.table(spark, sf_dir, "orders").groupBy(col("o_orderdate").cast("date").alias("dt")).agg(F.count("*").alias("cases"))
    return a.join(b, "dt", "full")


@query("anti_bad_samples", f"{HOT} SELECT sample_id, analyte, result FROM hot WHERE sample_id NOT IN (SELECT sample_id FROM hot WHERE result = -2 AND age > 100)")
def anti_bad_samples(spark, sf_dir):
    rows = frames.hot(spark, sf_dir).select("sample_id", "analyte", "result", "age")
    bad = rows.where((col("result") == -2) & (col("age") > 100))
    return filters.without_groups(rows, bad, "sample_id").drop("age")


@query("calendar_counts", f"{LONG}, {ob.EPIWEEKS} SELECT w.start_date, w.end_date, w.week_num, COUNT(l.test_id) AS test_count FROM epiweeks w LEFT JOIN long_rows l ON l.date_testing BETWEEN w.start_date AND w.end_date GROUP BY ALL")
def calendar_counts(spark, sf_dir):
    weeks = joins.calendar(spark).select("start_date", "end_date", "week_num")
    return joins.counts_per_week(tb.long_results(spark, sf_dir), weeks)


# -- upserts -----------------------------------------------------------------

_OLD = "TIMESTAMP '2025-01-01 00:00:00'"
_HALVES = f"{SAMPLES}, tgt AS (SELECT * REPLACE ('NT' AS VSR_test_result), {_OLD} AS created_at, {_OLD} AS updated_at FROM samples WHERE CAST(test_id AS BIGINT) % 3 != 0), src AS (SELECT * REPLACE ('src.csv' AS file_name), {ob.NOW_LOCAL} AS created_at, {ob.NOW_LOCAL} AS updated_at FROM samples WHERE CAST(test_id AS BIGINT) % 3 != 1)"


def halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows, third = frames.samples(spark, sf_dir), col("test_id").cast("bigint") % 3
    old = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    target = upsert.stamp(rows.where(third != 0).withColumn("VSR_test_result", F.lit("NT")), old)
    source = upsert.stamp(rows.where(third != 1).withColumn("file_name", F.lit("src.csv")), now())
    return target, source


@query("upsert_merge", f"{_HALVES} SELECT COALESCE(s.sample_id, t.sample_id) AS sample_id, CASE WHEN s.sample_id IS NULL THEN t.file_name ELSE s.file_name END AS file_name, CASE WHEN s.sample_id IS NULL THEN t.VSR_test_result ELSE s.VSR_test_result END AS VSR_test_result, COALESCE(t.created_at, s.created_at) AS created_at, CASE WHEN s.sample_id IS NULL THEN t.updated_at ELSE s.updated_at END AS updated_at FROM tgt t FULL OUTER JOIN src s ON t.sample_id = s.sample_id")
def upsert_merge(spark, sf_dir):
    """Two batches merged one after the other into a stored table."""
    path = f"{checkpoint_dir(spark)}/io/upsert-{uuid.uuid4().hex}"
    for batch in halves(spark, sf_dir):
        buckets.merge_into(spark, path, batch, upsert.merge, buckets=16)
    return buckets.read(spark, path).select("sample_id", "file_name", "VSR_test_result", "created_at", "updated_at")


_DECISIVE = ", ".join(f"CASE WHEN t.{c} = 'NT' OR t.{c} IS NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in vocab.RESULT_COLUMNS)


@query("upsert_keep_decisive", f"{_HALVES} SELECT s.sample_id, s.file_name, {_DECISIVE} FROM src s LEFT JOIN tgt t ON s.sample_id = t.sample_id")
def upsert_keep_decisive(spark, sf_dir):
    return upsert.keep_decisive(*halves(spark, sf_dir)).select("sample_id", "file_name", *vocab.RESULT_COLUMNS)


# -- unions ------------------------------------------------------------------

_NOW2 = f"{ob.NOW_LOCAL} AS created_at, {ob.NOW_LOCAL} AS updated_at"
_COLS = ", ".join(["lab_id", *vocab.PANEL_COLUMNS])
# the table of each laboratory by the name that its rows carry; those of the archive-only one stand for another's
_LAB_TABLES = {"DBMOL": "DBMOL", "FLEURY": "FLEURY", "SABIN": "SABIN", "HILAB": "HILAB", "TARGET": "DASA"}
_UNIONS = " UNION ".join(f"SELECT {_COLS} FROM (SELECT * REPLACE ('{lab}' AS lab_id) FROM labs WHERE lab_id = '{rows}') WHERE date_testing >= DATE '2024-01-01'" for lab, rows in _LAB_TABLES.items())


@query("union_cutover", f"{SAMPLES}, {oracle_labs.ARCHIVE}, labs AS (SELECT *, {_NOW2} FROM samples) SELECT {_COLS} FROM archive_final WHERE date_testing < DATE '2024-01-01' AND lab_id NOT IN ('DASA') UNION SELECT {_COLS} FROM archive_final WHERE lab_id IN ('DASA') UNION {_UNIONS}")
def union_cutover(spark, sf_dir):
    rows = upsert.stamp(frames.samples(spark, sf_dir), now())
    labs = {lab: rows.where(col("lab_id") == name).drop("lab_id") for lab, name in _LAB_TABLES.items()}
    return panel.join_labs(archive.final(tb.raw_archive(spark, sf_dir), now()), labs)


# -- aggregates --------------------------------------------------------------


@query("conditional_sums", f"{LONG} SELECT lab_id, CAST(SUM(CASE WHEN result = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos, MAX(CASE WHEN analyte = 'SC2' THEN age END) AS oldest_sc2, COUNT(CASE WHEN sex IS NOT NULL THEN 1 END) AS with_sex FROM long_rows GROUP BY lab_id")
def conditional_sums(spark, sf_dir):
    return tb.long_results(spark, sf_dir).groupBy("lab_id").agg(
        F.sum(F.when(col("result") == 1, 1).otherwise(0)).alias("pos"), F.max(F.when(col("analyte") == "SC2", col("age"))).alias("oldest_sc2"),
        F.count(F.when(col("sex").isNotNull(), 1)).alias("with_sex"),
    )


@query("count_by_keys", f"{LONG} SELECT lab_id, test_kit, analyte, result, COUNT(*) AS n FROM long_rows GROUP BY ALL")
def count_by_keys(spark, sf_dir):
    return tb.long_results(spark, sf_dir).groupBy("lab_id", "test_kit", "analyte", "result").agg(F.count("*").alias("n"))


@query("distinct_count", f"{LONG} SELECT lab_id, strftime(date_testing, '%Y-%m') AS month, COUNT(DISTINCT test_id) AS samples, COUNT(DISTINCT state) AS states FROM long_rows GROUP BY ALL")
def distinct_count(spark, sf_dir):
    return tb.long_results(spark, sf_dir).groupBy("lab_id", dates.year_month(col("date_testing")).alias("month")).agg(
        F.count_distinct("test_id").alias("samples"), F.count_distinct("state").alias("states")
    )


@query("having_groups", f"{LONG} SELECT test_id, COUNT(*) AS n FROM long_rows GROUP BY test_id HAVING COUNT(*) > 5")
def having_groups(spark, sf_dir):
    return tb.long_results(spark, sf_dir).groupBy("test_id").agg(F.count("*").alias("n")).where(col("n") > 5)


@query("distinct_places", f"WITH {tb.DUCK_GEOGRAPHY} SELECT DISTINCT {ob.norm('state_name')} AS state_name, region FROM macroregions")
def distinct_places(spark, sf_dir):
    return tb.macroregions(spark, sf_dir).select(text.normalize_text(col("state_name")).alias("state_name"), "region").distinct()


@query("group_totals", f"WITH {tb.DUCK_GEOGRAPHY} SELECT DS_UF_SIGLA AS state_code, CAST(SUM(Populacao) AS BIGINT) AS people FROM macroregions WHERE ADM2_PCODE ILIKE 'BR%' GROUP BY ALL")
def group_totals(spark, sf_dir):
    return population(tb.macroregions(spark, sf_dir), by_city=False)


# -- windows, order, ranking -------------------------------------------------

_DAILY = "SELECT lab_id, date_testing, COUNT(*) AS n FROM long_rows GROUP BY ALL"


@query("running_cases", f"{LONG}, d AS ({_DAILY}) SELECT lab_id, date_testing, n, CAST(SUM(n) OVER (PARTITION BY lab_id ORDER BY date_testing) AS BIGINT) AS total FROM d")
def running_cases(spark, sf_dir):
    daily = tb.long_results(spark, sf_dir).groupBy("lab_id", "date_testing").agg(F.count("*").alias("n"))
    return daily.withColumn("total", windows.running_total("n", ["lab_id"], "date_testing"))


@query("row_number_pick", f"{LONG}, d AS ({_DAILY}) SELECT lab_id, date_testing, n FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY lab_id ORDER BY date_testing) AS rn FROM d) WHERE rn = 1")
def row_number_pick(spark, sf_dir):
    daily = tb.long_results(spark, sf_dir).groupBy("lab_id", "date_testing").agg(F.count("*").alias("n"))
    order = Window.partitionBy("lab_id").orderBy("date_testing")
    return daily.withColumn("rn", F.row_number().over(order)).where(col("rn") == 1).drop("rn")


@query("latest_rows", f"{LONG}, d AS ({_DAILY}) SELECT * FROM d WHERE date_testing >= (SELECT MAX(date_testing) FROM d)")
def latest_rows(spark, sf_dir):
    return filters.latest(tb.long_results(spark, sf_dir).groupBy("lab_id", "date_testing").agg(F.count("*").alias("n")), "date_testing")


@query("top_k", f"{LONG}, d AS (SELECT lab_id, test_kit, COUNT(*) AS n FROM long_rows GROUP BY ALL) SELECT lab_id, test_kit, n, CAST(rn AS INTEGER) AS rank FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY lab_id ORDER BY n DESC, test_kit) AS rn FROM d) WHERE rn <= 4")
def top_k(spark, sf_dir):
    counts = tb.long_results(spark, sf_dir).groupBy("lab_id", "test_kit").agg(F.count("*").alias("n"))
    return windows.top_k(counts, ["lab_id"], "n", 4, ["test_kit"])


@query("sorted_rows", f"{LONG} SELECT test_id, age, sex, analyte FROM long_rows ORDER BY age DESC NULLS FIRST, sex ASC NULLS LAST")
def sorted_rows(spark, sf_dir):
    return windows.sort_like_postgres(tb.long_results(spark, sf_dir).select("test_id", "age", "sex", "analyte"), ("age", "desc"), ("sex", "asc"))


# -- reports -----------------------------------------------------------------


@query("city_report", f"{PANEL} SELECT date_testing, test_kit, age_group, 'Rio de Janeiro' AS location, 'RJ' AS state_code, location_ibge_code, u.pathogen, u.result, COUNT(*) AS quantity FROM panel r CROSS JOIN LATERAL (VALUES {ob._TUPLES}) AS u(result, pathogen) WHERE location_ibge_code = 3304557 AND u.result <> 'NT' GROUP BY ALL")
def city_report(spark, sf_dir):
    return reports.city_report(frames.full_panel(spark, sf_dir))


_VOLUME, _COUNTS = "matrix_30_Resp_bar_total_posneg_week_regions", "matrix_ALL_count_by_labid_testkit_pathogen_result"
_MAIN, _OTHERS, _WIDE = "matrix_02_Resp_bar_pos_panel4_week_country_r", "matrix_06_Resp_line_posrate_direct_week_country_r", "matrix_07_Resp_bar_pos_panel20PLUS_week_country_r"


def _headline_sql() -> str:
    tables = oracle_matrices.sql()
    spelled = f"COALESCE({ob.case_map('lower(trim(name))', vocab.LABEL_SPELLING)}, lower(trim(name)))"

    def newest(name: str, pathogens: list[str]) -> str:
        """The last week's row of a table, turned, with the share of its sum."""
        week = '"semana epidemiológica"'
        rows = " UNION ALL ".join(
            f"SELECT {i} AS position, '{vocab.PATHOGEN_LABELS[p]}' AS name, CAST(\"{vocab.PATHOGEN_LABELS[p]}\" AS DOUBLE) AS value FROM last" for i, p in enumerate(pathogens)
        )
        return (
            f"(WITH q AS MATERIALIZED ({tables[name]}), last AS (SELECT * FROM q WHERE {week} = (SELECT MAX({week}) FROM q)), x AS ({rows}) "
            f"SELECT value, {spelled} AS name, CASE WHEN SUM(COALESCE(value, 0)) OVER () > 0 THEN COALESCE(value, 0) / SUM(COALESCE(value, 0)) OVER () * 100 ELSE 0 END AS share, "
            "ROW_NUMBER() OVER (ORDER BY COALESCE(value, 0) DESC, position) AS place FROM x)"
        )

    whole = lambda v: f"CAST(floor({v} + 0.5) AS INTEGER)"
    text = lambda v: f"name || ' (' || {whole(v)} || '%)'"
    tops = ", ".join(
        f"(SELECT name FROM main WHERE place = {i}) AS top_pathogen_{i}_name, (SELECT {whole('share')} FROM main WHERE place = {i}) AS top_pathogen_{i}_positive_share" for i in range(1, 5)
    )
    return (
        f"WITH {ob.EPIWEEKS}, volume AS MATERIALIZED ({tables[_VOLUME]}), main AS MATERIALIZED {newest(_MAIN, matrices.FOUR)}, others AS MATERIALIZED {newest(_OTHERS, matrices.OTHERS)}, "
        f"wide AS MATERIALIZED {newest(_WIDE, matrices.PANEL20)}, rest AS (SELECT place, {text('share')} AS part FROM wide WHERE place > 1 AND {whole('share')} > 0), "
        "c AS (SELECT CAST(MAX(\"Semana Epidemiológica\") AS DATE) AS day FROM volume) "
        "SELECT strftime(day, '%d/%m/%Y') AS lab_data_cutoff_date, "
        f"(SELECT replace(format('{{:,}}', CAST(SUM(\"count\") AS BIGINT)), ',', '.') FROM ({tables[_COUNTS]})) AS total_results_cumulative, "
        "(SELECT CAST(week_num AS VARCHAR) FROM epiweeks WHERE day BETWEEN start_date AND end_date) AS lab_data_cutoff_epiweek, "
        f"{tops}, day(day) || '/' || month(day) AS sivep_data_extraction_date, "
        f"(SELECT COALESCE(string_agg({text('value')}, ', ' ORDER BY place), '') FROM others WHERE value > 0) AS others_top_positivities, "
        f"(SELECT name FROM wide WHERE place = 1) AS top_other_pathogen_name, (SELECT {whole('share')} FROM wide WHERE place = 1) AS top_other_pathogen_positive_share, "
        "(SELECT COALESCE(CASE WHEN COUNT(*) > 1 THEN array_to_string(list(part ORDER BY place)[1:-2], ', ') || ' e ' || last(part ORDER BY place) ELSE MAX(part) END, '') FROM rest) AS other_pathogens_positive_shares "
        "FROM c"
    )


@query("headline_indicators", _headline_sql())
def headline_indicators(spark, sf_dir):
    return reports.headline(frames.source(spark, sf_dir, with_register=False))
