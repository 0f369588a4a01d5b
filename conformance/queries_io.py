"""Registered queries of ingest, export and streaming. They write what they read back into a new folder each time."""

from __future__ import annotations

import datetime
import uuid
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conformance import frames, oracle_base as ob, oracle_labs, oracle_matrices
from conformance import testbed as tb
from conformance.queries_labs import now
from conformance.queries_operators import _HALVES, SQL, C, SAMPLES, T, col, halves, query
from labwatch import labs_vocab as lv
from labwatch import vocab
from labwatch.operators import joins, upsert
from labwatch.plans import matrices, register, reports
from labwatch.plans.labs import sabin_typed
from labwatch.session import checkpoint_dir
from labwatch.sinks import buckets, files, tables
from labwatch.sources import header_repair
from labwatch.sources.delimited import FORMATS, read_delimited, read_lab, read_sheets
from labwatch.streaming import drop_folder, weekly


def scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/io/{name}-{uuid.uuid4().hex}"


def delivered(spark: SparkSession, sf_dir: str, lab_id: str, parts: int = 3) -> str:
    """A laboratory's raw rows as files in its own format; a sample's rows stay in one file."""
    folder = scratch(spark, lab_id.lower())
    raw = tb.raw(spark, sf_dir, lab_id).drop("file_name")
    sep, encoding = FORMATS[lab_id]
    files.write_delimited(raw.repartition(parts, raw.columns[0]), folder, sep, encoding=encoding)
    return folder


def dropped_files(spark: SparkSession, sf_dir: str) -> int:
    """Files of a delivery, three at least: their number, and that of the table's buckets, grows with the line items."""
    return max(3, tb.shares(spark, sf_dir))


def _raw_sql(lab_id: str) -> str:
    return f"{T}, raw AS ({tb.duck(tb.RAW[lab_id])})"


@query("ingest_semicolon_latin1", f"{_raw_sql('HPARDINI')} SELECT * EXCLUDE (file_name) FROM raw")
def ingest_semicolon_latin1(spark, sf_dir):
    return read_lab(spark, "HPARDINI", delivered(spark, sf_dir, "HPARDINI")).drop("file_name")


@query("ingest_tabs_latin1", f"{_raw_sql('FLEURY')} SELECT * EXCLUDE (file_name) FROM raw")
def ingest_tabs_latin1(spark, sf_dir):
    return read_lab(spark, "FLEURY", delivered(spark, sf_dir, "FLEURY")).drop("file_name")


@query("ingest_column_subset", f"{_raw_sql('DBMOL')} SELECT NumeroPedido, Resultado, TRUE AS has_file FROM raw")
def ingest_column_subset(spark, sf_dir):
    rows = read_lab(spark, "DBMOL", delivered(spark, sf_dir, "DBMOL"), ["NumeroPedido", "Resultado"])
    return rows.select("NumeroPedido", "Resultado", col("file_name").endswith(".csv").alias("has_file"))


_TYPED = ", ".join(
    f"{ob.norm(c)} AS {c.lower()}" if c in ("ID_MN_RESI", "SG_UF")
    else f"TRY_CAST({c} AS DATE) AS {c.lower()}" if c in lv.REGISTER_DATES
    else f"{ob._int(c)} AS {c.lower()}" if c in lv.REGISTER_NUMBERS
    else f"CAST(replace({c}, ';', '') AS INTEGER) AS {c.lower()}" if c == "CRITERIO"
    else f"{c} AS {c.lower()}"
    for c in lv.REGISTER_COLUMNS
)


@query("ingest_register", f"{C}, raw AS ({tb.duck(tb.REGISTER)}) SELECT {_TYPED} FROM raw")
def ingest_register(spark, sf_dir):
    folder = scratch(spark, "register")
    extra = tb.raw_register(spark, sf_dir).drop("file_name").withColumn("UNUSED", F.lit("x"))
    files.write_delimited(extra, folder, ";", encoding="ISO-8859-1")
    return register.typed(read_lab(spark, "REGISTER", folder, lv.REGISTER_COLUMNS)).drop("file_name")


@query("ingest_sheets", f"{_raw_sql('EINSTEIN')} SELECT accession, exame, resultado, dh_coleta, CASE WHEN CAST(accession AS BIGINT) % 3 = 2 THEN NULL ELSE patogeno END AS patogeno FROM raw")
def ingest_sheets(spark, sf_dir):
    """Three sheets, the last without one column and with its dates as timestamps."""
    raw = tb.raw(spark, sf_dir, "EINSTEIN").drop("file_name")
    paths = []
    for i, name in enumerate(("sheet_a", "sheet_b", "sheet_c")):
        sheet = raw.where(col("accession").cast("bigint") % 3 == i)
        if i == 2:
            d = col("dh_coleta")
            iso = F.concat(F.substring(d, 7, 4), F.lit("-"), F.substring(d, 4, 2), F.lit("-"), F.substring(d, 1, 2), F.lit(" 00:00:00"))
            sheet = sheet.drop("patogeno").withColumn("dh_coleta", iso)
        paths.append(f"{scratch(spark, name)}")
        files.write_delimited(sheet, paths[-1])
    rows = header_repair.prepare("EINSTEIN", read_sheets(spark, paths))
    return rows.select("accession", "exame", "resultado", "dh_coleta", "patogeno")


@query("ingest_header_repair", f"{T}, raw AS (SELECT r.*, CAST(l_quantity AS INTEGER) AS q FROM (SELECT * FROM tests) t, LATERAL ({tb.duck(tb.RAW['HLAGYN']).replace('FROM tests', '')}) r) SELECT Pedido, \"Métodologia\" AS method, UF, Resultado, concat('v', q) AS \"CT_I\", CAST(NULL AS VARCHAR) AS \"VIRUS_EV\" FROM raw")
def ingest_header_repair(spark, sf_dir):
    """Misspelt headers, a column named by its values and a blank one."""
    rows = spark.sql(
        tb.RAW["HLAGYN"].replace(" FROM {tests}", ", CAST(l_quantity AS INT) AS q FROM {tests}"), tests=tb.tests(spark, sf_dir)
    )
    messy = rows.select(
        "Pedido", "`Data Coleta`", "Idade", "Sexo", col("`Métodologia`").alias("Matodologia"), "Cidade", col("UF").alias("UF (Inst Saúde)"), "Resultado",
        F.concat(F.lit("CT_I: v"), col("q").cast("string")).alias("Resultado.1"), F.lit("  ").alias("Resultado.2"),
    )
    folder = scratch(spark, "hlagyn")
    files.write_delimited(messy, folder)
    fixed = header_repair.repair_hlagyn(read_delimited(spark, folder))
    return fixed.select("Pedido", col("`Métodologia`").alias("method"), "UF", "Resultado", "CT_I", "VIRUS_EV")


@query("ingest_mixed_dates", f"{C}, x AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'sem data' WHEN o_orderkey % 3 = 1 THEN CAST(dt AS VARCHAR) || ' 08:30:00' ELSE strftime(dt, '%m/%d/%Y') END AS d, dt FROM cases) SELECT o_orderkey, CASE WHEN d = 'sem data' THEN NULL ELSE CAST(dt AS VARCHAR) END AS DATACOLETA FROM x")
def ingest_mixed_dates(spark, sf_dir):
    d = F.when(col("o_orderkey") % 3 == 0, "sem data").when(col("o_orderkey") % 3 == 1, F.concat(col("dt").cast("string"), F.lit(" 08:30:00")))
    rows = tb.cases(spark, sf_dir).select("o_orderkey", d.otherwise(F.date_format("dt", "MM/dd/yyyy")).alias("DATACOLETA"))
    return header_repair.prepare("HPARDINI", rows)


_SABIN_DATES = "CAST(strptime(DataAtendimento, '%m/%d/%Y') AS DATE) AS date_testing, CAST(strptime(DataNascimento, '%m/%d/%Y') AS DATE) AS birth_date"


@query("ingest_date_orders", f"{_raw_sql('SABIN')} SELECT OS, {_SABIN_DATES} FROM raw")
def ingest_date_orders(spark, sf_dir):
    """Deliveries of both orders of day and month; each file's own is found."""
    folder, raw = scratch(spark, "sabin"), tb.raw(spark, sf_dir, "SABIN").drop("file_name")
    day_first = raw.withColumns({c: F.regexp_replace(c, "^(..)/(..)", "$2/$1") for c in ("DataAtendimento", "DataNascimento")})
    for i, rows in enumerate((raw, day_first)):
        files.write_delimited(rows.where(col("OS").cast("bigint") % 2 == i), f"{folder}/part={i}")
    typed = sabin_typed(header_repair.prepare("SABIN", read_lab(spark, "SABIN", f"{folder}/*")))
    return typed.select(col("test_id").alias("OS"), "date_testing", "birth_date")


@query("ingest_panel4_layout", f"{_raw_sql('HLAGYN')} SELECT Pedido, Idade, \"Vírus Influenza A\" AS flua, \"Vírus Influenza B\" AS flub, \"Coronavírus SARS-CoV-2\" AS sc2 FROM raw")
def ingest_panel4_layout(spark, sf_dir):
    """Files with the short headers of the small panel, told by one of them."""
    back = {v: k for k, v in lv.HLAGYN_PANEL4_HEADERS.items()}
    raw = tb.raw(spark, sf_dir, "HLAGYN").drop("file_name", *back.values()).withColumnsRenamed(back)
    folder = scratch(spark, "panel4")
    files.write_delimited(raw, folder)
    rows = header_repair.apply_layout(read_delimited(spark, folder), "VIRUS_HRSV", lv.HLAGYN_PANEL4_HEADERS)
    return rows.select("Pedido", "Idade", col("`Vírus Influenza A`").alias("flua"), col("`Vírus Influenza B`").alias("flub"), col("`Coronavírus SARS-CoV-2`").alias("sc2"))


@query("dimension_csv", f"WITH {tb.DUCK_GEOGRAPHY} SELECT CAST(CD_MUN AS VARCHAR) AS code, NM_MUN AS name, NM_UF AS state FROM municipalities")
def dimension_csv(spark, sf_dir):
    """A dimension delivered as text with blanks behind its commas."""
    folder, m = scratch(spark, "dimension"), tb.municipalities(spark, sf_dir)
    line = F.concat_ws(", ", col("CD_MUN").cast("string"), "NM_MUN", F.concat("NM_UF", F.lit(" ")))
    header = spark.range(1).select(F.lit("code, name , state").alias("value"))
    header.unionByName(m.select(line.alias("value"))).coalesce(1).write.text(folder)
    return joins.read_dimension(spark, folder).select("code", "name", "state")


_AS_TEXT = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in ["sample_id", "age", "date_testing", "location", *vocab.RESULT_COLUMNS, "qty_original_lines"])


@query("export_tsv", f"{SAMPLES} SELECT {_AS_TEXT} FROM samples")
def export_tsv(spark, sf_dir):
    folder = scratch(spark, "tsv")
    files.write_tsv(frames.samples(spark, sf_dir), folder)
    rows = spark.read.csv(folder, sep="\t", header=True, inferSchema=False)
    return rows.select("sample_id", "age", "date_testing", "location", *vocab.RESULT_COLUMNS, "qty_original_lines")


_BARS = "matrix_02_Resp_bar_pos_panel4_week_country_h"
_BARS_TEXT = f"WITH q AS ({oracle_matrices.sql()[_BARS]}) SELECT CAST(COLUMNS(*) AS VARCHAR) FROM q"


def _orders() -> dict:
    return {name: m.order for name, m in matrices.MATRICES.items()}


@query("export_catalogue", _BARS_TEXT)
def export_catalogue(spark, sf_dir):
    folder = scratch(spark, "catalogue")
    names = [_BARS, "matrix_07_Resp_bar_pos_panel20PLUS_week_country_h", "matrix_ALL_count_by_labid_testkit_pathogen_result"]
    tables = matrices.build_all(frames.source(spark, sf_dir, with_register=False), names)
    files.export_catalogue(tables, folder, {n: matrices.file_name(n) for n in names}, _orders())
    return spark.read.csv(f"{folder}/{matrices.file_name(_BARS)}.csv", header=True, inferSchema=False)


_SIZES = "SELECT '{name}' AS name, (SELECT COUNT(*) FROM chosen) AS n_rows, (SELECT COUNT(*) FROM (SELECT CAST(COLUMNS(*) AS VARCHAR) FROM chosen) UNPIVOT (v FOR c IN (COLUMNS(*)))) AS n_cells"


@query("export_all", oracle_matrices.together(_SIZES))
def export_all(spark, sf_dir):
    """All published tables, exported side by side and read back: rows and filled cells of each file."""
    folder = scratch(spark, "catalogue")
    names = list(matrices.MATRICES)
    paths = files.export_catalogue(matrices.build_all(frames.source(spark, sf_dir)), folder, {n: matrices.file_name(n) for n in names}, _orders())

    def sizes(item: tuple[str, str]) -> tuple[str, int, int]:
        df = files.read_written(spark, item[1])
        cells = reduce(add, [F.count(f"`{c}`") for c in df.columns])
        return (item[0], *df.agg(F.count("*"), cells).first())  # one row for each table

    return spark.createDataFrame(files.at_once(spark, sizes, zip(names, paths)), "name string, n_rows bigint, n_cells bigint")


_CITY_SQL = SQL["city_report"]


@query("city_report_file", f"WITH q AS ({_CITY_SQL}) SELECT CAST(COLUMNS(*) AS VARCHAR) FROM q")
def city_report_file(spark, sf_dir):
    """The city report written and read back."""
    path = reports.export_city_report(frames.full_panel(spark, sf_dir), scratch(spark, "city"))
    return files.read_written(spark, path, "\t")


@query("publish_release", _BARS_TEXT)
def publish_release(spark, sf_dir):
    """The public copy of the current release."""


    root, public = scratch(spark, "reports"), scratch(spark, "public")
    src = frames.source(spark, sf_dir, with_register=False)
    release = files.release_name(datetime.datetime(2026, 2, 17, 14, 5), "weekly")
    files.publish({_BARS: matrices.build_matrix(_BARS, src)}, root, public, release, {_BARS: matrices.file_name(_BARS)}, _orders())
    return files.read_written(spark, f"{public}/current/matrices/csv/{matrices.file_name(_BARS)}.csv")


_LAB_COLUMNS = ["sample_id", "test_id", "test_kit", "sex", "age", "location", "state", "date_testing", *vocab.RESULT_COLUMNS, "qty_original_lines"]


@query("stream_drop_folder", f"WITH q AS ({oracle_labs.lab_sql('HPARDINI').replace(chr(34) + 'file_name' + chr(34) + ' NULLS FIRST, ', '')}) SELECT {', '.join(_LAB_COLUMNS)}, {ob.NOW_LOCAL} AS created_at FROM q")
def stream_drop_folder(spark, sf_dir):
    """Dropped files merged in two batches into a table in buckets, twice over to show that nothing is doubled."""
    parts = dropped_files(spark, sf_dir)
    folder, table, two_thirds = delivered(spark, sf_dir, "HPARDINI", parts), scratch(spark, "table"), -(-2 * parts // 3)
    for run in ("first", "again"):
        drop_folder.ingest_lab(spark, "HPARDINI", folder, table, scratch(spark, run), now, per_batch=two_thirds, buckets=max(8, parts)).awaitTermination()
    return buckets.read(spark, table).select(*_LAB_COLUMNS, "created_at")


_BROKEN = "concat('x;', CODIGO, ';a;b;c;d;e;f;g;h;too many')"


@query("stream_quarantine", f"WITH q AS ({oracle_labs.lab_sql('HPARDINI').replace(chr(34) + 'file_name' + chr(34) + ' NULLS FIRST, ', '')}), b AS (SELECT DISTINCT 'x;' || CODIGO || ';a;b;c;d;e;f;g;h;too many' AS line FROM ({tb.duck(tb.RAW['HPARDINI']).replace('FROM tests', f'FROM (WITH {tb.DUCK_TESTS} SELECT * FROM tests)')}) r) SELECT 'sample' AS kind, test_id AS what, SC2_test_result AS outcome FROM q UNION ALL SELECT 'broken', line, 'broken.csv' FROM b WHERE line IN (SELECT MAX(line) FROM b)")
def stream_quarantine(spark, sf_dir):
    """A delivery with a row of too many fields: its other rows arrive, that one is set apart."""
    parts = dropped_files(spark, sf_dir)
    folder, table, aside, done = delivered(spark, sf_dir, "HPARDINI", parts), scratch(spark, "table"), scratch(spark, "aside"), scratch(spark, "done")
    raw = tb.raw(spark, sf_dir, "HPARDINI").drop("file_name")
    worst = raw.agg(F.max(F.expr(_BROKEN)).alias("line"))
    header = ";".join(raw.columns)
    text = worst.select(F.encode(F.concat_ws("\n", F.lit(header), "line"), "ISO-8859-1").alias("content"))
    buckets.Storage(spark, folder).put(f"{folder}/broken.csv", bytes(text.first()["content"]))
    drop_folder.ingest_lab(spark, "HPARDINI", folder, table, scratch(spark, "first"), now, archive=done, quarantine=aside, buckets=max(8, parts)).awaitTermination()
    samples = buckets.read(spark, table).select(F.lit("sample").alias("kind"), col("test_id").alias("what"), col("SC2_test_result").alias("outcome"))
    return samples.unionByName(spark.read.parquet(aside).select(F.lit("broken").alias("kind"), col("broken_line").alias("what"), col("file_name").alias("outcome")))


_PARTS = {0: "CODIGO, DATACOLETA, RESULTADO", 1: "RESULTADO, CODIGO, DATACOLETA", 2: "DATACOLETA, RESULTADO, CODIGO, 'x' AS NOVA"}


@query("ingest_layouts", f"{_raw_sql('HPARDINI')} SELECT CODIGO, DATACOLETA, RESULTADO, CASE WHEN CAST(CODIGO AS BIGINT) % 3 = 2 THEN 'x' END AS NOVA FROM raw")
def ingest_layouts(spark, sf_dir):
    """One folder with files of three column orders, one of them with a column more."""
    folder, raw = scratch(spark, "layouts"), tb.raw(spark, sf_dir, "HPARDINI")
    for i, columns in _PARTS.items():
        part = raw.where(col("CODIGO").cast("bigint") % 3 == i).selectExpr(*columns.split(", "))
        files.write_delimited(part, f"{folder}/part={i}", ";", encoding="ISO-8859-1")
    return read_lab(spark, "HPARDINI", f"{folder}/*").select("CODIGO", "DATACOLETA", "RESULTADO", "NOVA")


@query("bucketed_merge", f"{_HALVES} SELECT COALESCE(s.sample_id, t.sample_id) AS sample_id, COALESCE(s.file_name, t.file_name) AS file_name, COALESCE(t.created_at, s.created_at) AS created_at FROM tgt t FULL OUTER JOIN src s ON s.sample_id = t.sample_id")
def bucketed_merge(spark, sf_dir):
    """A batch merged with a catalog table that is bucketed by the key: the table does not move."""
    target, source = halves(spark, sf_dir)
    name = f"kept_{uuid.uuid4().hex}"
    # a task holds one bucket: their number grows with the line items, the rows of one do not
    table = tables.as_bucketed_table(target, name, "sample_id", max(16, tb.shares(spark, sf_dir)), scratch(spark, name))
    return upsert.merge(table, tables.as_table(source, scratch(spark, "batch"))).select("sample_id", "file_name", "created_at")


@query("view_kits", f"{SAMPLES} SELECT test_kit, COUNT(*) AS samples, CAST(SUM(qty_original_lines) AS BIGINT) AS lines FROM samples GROUP BY ALL")
def view_kits(spark, sf_dir):
    name = f"samples_{uuid.uuid4().hex}"
    tables.as_view(frames.samples(spark, sf_dir), name)
    return spark.sql(f"SELECT test_kit, COUNT(*) AS samples, SUM(qty_original_lines) AS lines FROM {name} GROUP BY test_kit")


_WEEK = "date_trunc('week', ts + INTERVAL 1 DAY) - INTERVAL 1 DAY"


@query("epiweek_tumbling", f"WITH g AS (SELECT CAST({_WEEK} AS DATE) AS epiweek_start, CAST({_WEEK} + INTERVAL 6 DAY AS DATE) AS epiweek_enddate, user_id % 3 AS grp, CAST(SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS pos, CAST(SUM(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS neg, COUNT(*) AS events FROM events GROUP BY ALL) SELECT *, CASE WHEN pos + neg >= 50 THEN CAST(pos AS DOUBLE) / (pos + neg) END AS posrate FROM g")
def epiweek_tumbling(spark, sf_dir):
    """Events as a stream; the table is rewritten as the weeks grow."""
    out = scratch(spark, "weekly")
    stream = (
        spark.readStream.schema(tb.SCHEMAS["events"].replace("timestamp_ntz", "timestamp")).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
        .withColumn("grp", col("user_id") % 3)
    )
    counted = weekly.weekly_positivity(stream, "ts", col("event_type") == "purchase", col("event_type") == "view", ["grp"])

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    (
        counted.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", scratch(spark, "state"))
        .trigger(availableNow=True).start().awaitTermination()
    )
    return spark.read.parquet(out)


_CLOSED = f"CAST({_WEEK} AS TIMESTAMP) + INTERVAL 7 DAY <= (SELECT MAX(ts) FROM events) - INTERVAL 7 DAY"


@query("epiweek_append", f"WITH g AS (SELECT CAST({_WEEK} AS DATE) AS epiweek_start, CAST({_WEEK} + INTERVAL 6 DAY AS DATE) AS epiweek_enddate, CAST(SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS pos, CAST(SUM(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS neg, COUNT(*) AS events FROM events WHERE {_CLOSED} GROUP BY ALL) SELECT *, CASE WHEN pos + neg >= 50 THEN CAST(pos AS DOUBLE) / (pos + neg) END AS posrate FROM g")
def epiweek_append(spark, sf_dir):
    """A week at a time, each delivery followed by events of the week before that come again, the last by events that are weeks late: closed weeks stay as they are."""
    inbox, out = scratch(spark, "inbox"), scratch(spark, "closed")
    schema = tb.SCHEMAS["events"].replace("timestamp_ntz", "timestamp")
    events = spark.read.schema(schema).parquet(f"{sf_dir}/events.parquet")
    day = weekly.epi_window(col("ts"))["start"]
    weeks = [r[0] for r in events.select(day.alias("w")).distinct().orderBy("w").collect()]  # a calendar's few weeks
    for i, week in enumerate(weeks):
        rows = events.where(day == F.lit(week))
        if i:
            rows = rows.unionByName(events.where((day == F.lit(weeks[i - 1])) & (col("ts") >= F.lit(week) - F.expr("INTERVAL 3 DAYS"))))
        if i == len(weeks) - 1:
            rows = rows.unionByName(events.where(day == F.lit(weeks[0])).withColumn("event_id", -col("event_id") - 1))
        rows.repartition(2).write.mode("append").parquet(inbox)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(inbox)
    counted = weekly.weekly_positivity(stream, "ts", col("event_type") == "purchase", col("event_type") == "view", event="event_id")
    (
        counted.writeStream.outputMode("append").format("parquet").option("checkpointLocation", scratch(spark, "state"))
        .trigger(availableNow=True).start(out).awaitTermination()
    )
    return spark.read.schema(counted.schema).parquet(out)


# -- tables from the written cubes -------------------------------------------


def _from_cube(name: str, with_register: bool) -> None:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return matrices.build_all(frames.source(spark, sf_dir, with_register), [name])[name]

    query(f"cube_{name.removeprefix('matrix_')}", oracle_matrices.sql()[name])(build)


_from_cube("matrix_102_VRISP_posrate_posneg_week_state", False)
_from_cube("matrix_13_SC2_map_pos_direct_cities_h", False)
_from_cube("matrix_34_SC2_line_posrate_bar_pos_direct_week_regions_sivep", True)
_from_cube("matrix_31_Resp_pyr_pos_agegroups_all_quarter_country", False)
_from_cube("matrix_30_Resp_bar_total_posneg_week_regions", False)
_from_cube("matrix_30_Resp_bar_total_posneg_months_regions", False)
_from_cube("matrix_ALL_count_by_labid_testkit_pathogen_result", False)
