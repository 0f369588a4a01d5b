from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from labwatch import labs_vocab as lv
from labwatch.plans.labs import LABS, final
from labwatch.operators import upsert
from labwatch.sinks import buckets, files, tables
from labwatch.sources import delimited, header_repair
from labwatch.streaming import drop_folder, weekly

from .helpers import frame, tuples


def test_latin1_and_lineage(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("CODIGO;MÉTODO\n1;Ação\n".encode("latin-1"))
    df = delimited.read_lab(spark, "HPARDINI", str(tmp_path / "a.csv"))
    assert tuples(df) == [("1", "Ação", "a.csv")]


def test_sheets_stack_by_name(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,2\n")
    (tmp_path / "y.csv").write_text("b,c\n3,4\n")
    df = delimited.read_sheets(spark, [str(tmp_path / "x.csv"), str(tmp_path / "y.csv")])
    assert tuples(df, "a", "b", "c") == [("1", "2", None), (None, "3", "4")]


def test_header_repair(spark):
    df = frame(
        spark, "Idade string, Sexo string, Pedido string, `Data Coleta` string, metodo string, `Cidade (Inst Saúde)` string, UF string, Resultado string, `Resultado.1` string, `Resultado.2` string",
        ("1", "F", "p", "2024-01-01", "PCR", "X", "SP", "Detectado", None, " "), ("1", "F", "q", "2024-01-01", "PCR", "X", "SP", None, "CT_I: 12 ", None),
    )
    got = header_repair.repair_hlagyn(df)
    assert "Resultado.2" not in got.columns and set(lv.HLAGYN_RESULT_HEADERS) <= set(got.columns)
    assert tuples(got, "Resultado", "CT_I", "`Métodologia`", "Cidade") == [("Detectado", "", "PCR", "X"), (None, "12", "PCR", "X")]


def test_panel4_layout_and_missing_columns(spark):
    df = frame(spark, "VIRUS_HRSV string, VIRUS_IA string", ("a", "b"))
    assert header_repair.apply_layout(df, "VIRUS_HRSV", lv.HLAGYN_PANEL4_HEADERS).columns == ["Vírus Sincicial Respiratório A/B", "Vírus Influenza A"]
    with pytest.raises(ValueError):
        header_repair.require(df, ["Idade"], [])


def test_date_orders(spark):
    df = frame(spark, "DATACOLETA string", ("01/02/2024",), ("25/02/2024",), ("2024-02-03",), ("x",))
    assert tuples(header_repair.prepare("HPARDINI", df)) == [("2024-01-02",), ("2024-02-03",), ("2024-02-25",), (None,)]


def test_release_names():
    day = datetime(2026, 2, 17, 14, 5)
    assert files.release_name(day, "weekly") == "2026-02-17_14h05_weekly_SE06.2026_V1"
    assert files.release_name(day, "weekly", ["2026-02-16_10h00_weekly_SE06.2026_V12", "2026-02-16_11h00_weekly_SE06.2026_V3", "current"]).endswith("SE06.2026_V13")
    assert files.release_name(day, "weekly", ["2026-02-09_10h00_weekly_SE05.2026_V3"]).endswith("_V1")
    assert files.public_names(["01_a", "matrix_b", "101_c"]) == ["01_a", "101_c"]


def test_exports_round_trip(spark, tmp_path):
    df = frame(spark, "a string, b int", (' "x", y\t', 1), (None, 2))
    files.write_tsv(df, str(tmp_path / "t"))
    assert tuples(spark.read.csv(str(tmp_path / "t"), sep="\t", header=True, escape='"')) == [(' "x", y\t', "1"), (None, "2")]
    paths = files.export_catalogue({"m": df}, str(tmp_path / "c"), {"m": "01_m"}, {"m": [("b", "asc")]})
    assert paths[0].endswith("/01_m.csv") and spark.read.csv(paths[0], header=True).count() == 2


KEYED = "sample_id string, v string, created_at string"


def keyed(spark, *names, v="x"):
    return frame(spark, KEYED, *[(n, v, v) for n in names])


def state_of(root):
    """Every data file with its size and time of change."""
    return {str(p.relative_to(root)): (p.stat().st_size, p.stat().st_mtime_ns) for p in root.rglob("*.parquet")}


def test_a_merge_leaves_other_buckets_alone(spark, tmp_path):
    path, names = str(tmp_path / "t"), [f"k{i}" for i in range(60)]
    assert buckets.read(spark, path) is None
    buckets.merge_into(spark, path, keyed(spark, *names), upsert.merge, buckets=32)
    before = state_of(tmp_path)
    after = buckets.merge_into(spark, path, keyed(spark, "k1", "new", v="y"), upsert.merge)
    touched = {r[0] for r in keyed(spark, "k1", "new").select(buckets.bucket_of("sample_id", 32)).collect()}
    assert {b for b, v in after.files.items() if v == 2} == touched and len(touched) == 2
    now = state_of(tmp_path)
    assert all(now[f] == before[f] for f in before)  # nothing is rewritten in place
    added = {f for f in now if f not in before}
    assert added and all(any(f"merge_bucket={b}/merge_version=2/" in f for b in touched) for f in added)
    assert tuples(buckets.read(spark, path)) == sorted([(n, "x", "x") for n in names if n != "k1"] + [("k1", "y", "x"), ("new", "y", "y")])
    assert not list((tmp_path / "t" / "_staging").iterdir())


def test_only_states_with_a_manifest_count(spark, tmp_path):
    path = str(tmp_path / "t")
    buckets.merge_into(spark, path, keyed(spark, "a", "b"), upsert.merge, buckets=4)

    def dies(known, batch):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        buckets.merge_into(spark, path, keyed(spark, "c"), dies)
    # files of a merge that got as far as its manifest, from a state that is no longer the newest
    first = buckets.manifest(spark, path)
    for version in (1, 2):
        keyed(spark, "a", v="lost").withColumns({"merge_bucket": F.lit(0), "merge_version": F.lit(version + 1)}).write.mode("append").partitionBy("merge_bucket", "merge_version").parquet(path)
    assert buckets.manifest(spark, path) == first and tuples(buckets.read(spark, path), "sample_id", "v") == [("a", "x"), ("b", "x")]
    buckets.merge_into(spark, path, keyed(spark, "a", "b", "c", "d", "e", v="y"), upsert.merge)  # takes the place of what was left
    assert {r[1] for r in tuples(buckets.read(spark, path), "sample_id", "v")} == {"y"}
    with pytest.raises(RuntimeError, match="another merge"):
        buckets.merge_into(spark, path, keyed(spark, "z"), lambda known, batch: (buckets.merge_into(spark, path, keyed(spark, "q"), upsert.merge), upsert.merge(known, batch))[1])
    assert "z" not in {r[0] for r in tuples(buckets.read(spark, path), "sample_id")}


def test_batches_of_a_stream_are_merged_once_and_old_states_expire(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch, v in ((0, "x"), (1, "y"), (1, "again"), (0, "late")):
        buckets.merge_into(spark, path, keyed(spark, "a", v=v), upsert.merge, buckets=4, once=("s", batch))
    assert tuples(buckets.read(spark, path)) == [("a", "y", "x")]
    buckets.merge_into(spark, path, keyed(spark, "a", v="z"), upsert.merge, once=("other", 0))
    assert buckets.expire(spark, path, keep=1) == 2
    assert tuples(buckets.read(spark, path)) == [("a", "z", "x")] and buckets.manifest(spark, path).applied == {"s": 1, "other": 0}
    empty = buckets.merge_into(spark, str(tmp_path / "e"), keyed(spark), upsert.merge)
    assert empty.files == {} and buckets.read(spark, str(tmp_path / "e")).count() == 0


def test_a_bucketed_table_does_not_move(spark, tmp_path):
    """Neither for the anti join of untouched rows nor for the join with known ones, though nothing is broadcast."""
    table = tables.as_bucketed_table(keyed(spark, *[f"k{i}" for i in range(99)]), "kept_for_plan", "sample_id", 6, str(tmp_path / "kept"))
    batch = tables.as_table(keyed(spark, "k1", "new", v="y"), str(tmp_path / "batch"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = upsert.merge(table, batch)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        rows = tuples(merged)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = plan.split("SortMergeJoin")[1:]
    assert len(joins) == 3 and plan.count("Bucketed: true") == 2
    for before in plan.split("Bucketed: true")[:-1]:
        above = before[before.rindex("SortMergeJoin"):]  # from the join down to the table
        assert "Exchange" not in above
    assert len(rows) == 100 and ("k1", "y", "x") in rows
    spark.sql("DROP TABLE kept_for_plan")


HEADER = "CODIGO;DATACOLETA;PATÓGENO;MÉTODO;CIDADE;UF;SEXO;IDADE;RESULTADO\n"


def drop(folder, name, *lines):
    (folder / name).write_bytes((HEADER + "\n".join(lines) + "\n").encode("latin-1"))


def test_drop_folder_takes_each_file_once(spark, tmp_path):
    folder, table = tmp_path / "in", str(tmp_path / "table")
    folder.mkdir()
    row = "{};2024-02-03;SARS-CoV-2;PCR em tempo real;Recife;PE;F;30;{}"
    clock = lambda text: (lambda: F.lit(text))

    def run(text):
        drop_folder.ingest_lab(spark, "HPARDINI", str(folder), table, str(tmp_path / "cp"), clock(text)).awaitTermination()
        return tuples(buckets.read(spark, table), "test_id", "SC2_test_result", "created_at", "updated_at")

    drop(folder, "1.csv", row.format(1, "Positivo"), row.format(2, "Negativo"))
    assert run("t1") == [("1", "Pos", "t1", "t1"), ("2", "Neg", "t1", "t1")]
    drop(folder, "2.csv", row.format(2, "Positivo"), row.format(3, "Negativo"))
    assert run("t2") == [("1", "Pos", "t1", "t1"), ("2", "Pos", "t1", "t2"), ("3", "Neg", "t2", "t2")]
    assert run("t3") == [("1", "Pos", "t1", "t1"), ("2", "Pos", "t1", "t2"), ("3", "Neg", "t2", "t2")]


def test_late_events_are_left_to_the_watermark(spark, tmp_path):
    folder = tmp_path / "events"
    schema = "ts timestamp, ok boolean"

    def add(*days):
        frame(spark, schema, *[(datetime(2024, 1, d, 12), True) for d in days]).coalesce(1).write.mode("append").parquet(str(folder))

    add(3)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
    out = weekly.weekly_positivity(stream, "ts", F.col("ok"), ~F.col("ok"), minimum=1)
    query = lambda: out.writeStream.outputMode("append").format("parquet").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    for days in ((), (25,), (4,), (26,)):
        if days:
            add(*days)
        query()
    got = tuples(spark.read.parquet(str(tmp_path / "out")), "epiweek_enddate", "pos")
    assert got == [(date(2024, 1, 6), 1)]


def test_einstein_table_keeps_decisive_results(spark):
    columns = "accession string, sexo string, idade string, exame string, detalhe_exame string, dh_coleta string, municipio string, estado string, patogeno string, resultado string, file_name string"
    raw = lambda word: frame(spark, columns, ("1", "F", "30", "PCR COVID19 Express", "Resultado COVID-19:", "10/09/2025", "X", "SP", "p", word, "f"))
    plan = LABS["EINSTEIN"]
    first = final(plan, plan.wide(raw("Detectado")), None, F.lit("t1"))
    second = final(plan, plan.wide(raw("Não detectado")), first, F.lit("t2"))
    assert tuples(second, "SC2_test_result", "created_at", "updated_at", "test_kit") == [("Pos", "t1", "t2", "covid_pcr")]


def test_staged_table(spark, tmp_path):
    assert tables.as_table(frame(spark, "a int", (1,)), str(tmp_path / "x")).count() == 1


def test_layouts_meet_by_column_name(spark, tmp_path):
    for name, text in (("x.csv", "a,b\n1,x\n"), ("y [1].csv", "b,a\ny,2\n"), ("z.csv", 'a,b,c\n3,"two\nlines",extra\n')):
        (tmp_path / name).write_text(text)
    rows = delimited.read_delimited(spark, str(tmp_path), multi_line=True)
    assert tuples(rows, "a", "b", "c", "file_name") == [("1", "x", None, "x.csv"), ("2", "y", None, "y [1].csv"), ("3", "two\nlines", "extra", "z.csv")]
    (tmp_path / "bad.csv").write_text("a,b\n1,2,3\n")
    with pytest.raises(Exception, match="more fields than the header has"):
        delimited.read_delimited(spark, str(tmp_path / "bad.csv")).collect()


def test_published_copies_are_equal(spark, tmp_path):
    rows = [('say "hi", ok', "1"), ("back\\slash", " blanks "), ("line\nend", ""), (None, "x")]
    df = frame(spark, "a string, b string", *rows)
    root, public = str(tmp_path / "root"), str(tmp_path / "public")
    files.publish({"m": df}, root, public, "2026-02-17_14h05_weekly_SE06.2026_V1", {"m": "01_m"})
    for folder in (f"{root}/2026-02-17_14h05_weekly_SE06.2026_V1", f"{root}/current", f"{public}/SE06.2026", f"{public}/current"):
        assert tuples(files.read_written(spark, f"{folder}/matrices/csv/01_m.csv")) == tuples(df.replace("", None))


def test_a_replayed_batch_keeps_all_its_files(spark, tmp_path):
    inbox, seen = tmp_path / "in", []
    inbox.mkdir()
    for i in range(10):
        (inbox / f"{i}.csv").write_text("a\n1\n")

    def fail(paths, batch):
        raise RuntimeError("stop")

    with pytest.raises(Exception):
        drop_folder.ingest(spark, str(inbox), str(tmp_path / "ck"), fail, per_batch=10).awaitTermination()
    drop_folder.ingest(spark, str(inbox), str(tmp_path / "ck"), lambda paths, batch: seen.extend(paths), per_batch=1).awaitTermination()
    assert len(set(seen)) == 10


def jobs_of(spark, run):
    spark.sparkContext.setJobGroup(group := f"g{datetime.now().timestamp()}", "")
    try:
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_one_job_finds_all_headers(spark, tmp_path):
    counts = []
    for n in (3, 24):
        folder = tmp_path / f"n{n}"
        folder.mkdir()
        for i in range(n):
            (folder / f"{i}.csv").write_text(("a,b\n1,x\n", "\n b,a \nx,1\n", "a,b,c\n1,x,extra\n")[i % 3])
        counts.append(jobs_of(spark, lambda: delimited.layouts(spark, [str(folder)], ",", "UTF-8")))  # noqa: B023
        found = delimited.layouts(spark, [str(folder)], ",", "UTF-8")
        assert [(x.names, x.quoted, len(x.files)) for x in found] == [((" b", "a "), False, n // 3), (("a", "b"), False, n // 3), (("a", "b", "c"), False, n // 3)]
        assert delimited.read_delimited(spark, str(folder)).count() == n
    assert counts[0] == counts[1]


def test_headers_as_sparks_reader_has_them(spark, tmp_path):
    for name, text in (("a", 'x,"y,z",,X,last\n1,2,3,4,5\n'), ("b", "one\n1\n"), ("c", '"q ""r"" s";"t"\n1;2\n')):
        sep = ";" if name == "c" else ","
        (tmp_path / f"{name}.csv").write_text("\ufeff" + text)
        expected = spark.read.csv(str(tmp_path / f"{name}.csv"), header=True, sep=sep, quote='"', escape='"').columns
        assert delimited.read_delimited(spark, str(tmp_path / f"{name}.csv"), sep).columns == [*expected, "file_name"]
    (tmp_path / "latin").mkdir()
    (tmp_path / "latin" / "é.csv").write_bytes("ção;é\nà;é\xa0\n".encode("latin-1"))
    assert tuples(delimited.read_delimited(spark, str(tmp_path / "latin"), ";", "ISO-8859-1"), "ção", "é") == [("à", "é\xa0")]


def test_quoted_line_ends_are_read_without_asking(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b\n1,"two\nlines"\n2,plain\n')
    (tmp_path / "y.csv").write_text("a,b\n3,short\n4\n")
    rows = delimited.read_delimited(spark, str(tmp_path))
    assert tuples(rows, "a", "b") == [("1", "two\nlines"), ("2", "plain"), ("3", "short"), ("4", None)]


def test_broken_rows_are_set_apart_and_files_archived(spark, tmp_path):
    folder, table, done, aside = (tmp_path / n for n in ("in", "table", "done", "aside"))
    folder.mkdir()
    row = "{};2024-02-03;SARS-CoV-2;PCR em tempo real;Recife;PE;F;30;Positivo"
    drop(folder, "1.csv", row.format(1), "broken;" + row.format(9), row.format(2))
    drop(folder, "2.csv", row.format(3) + ";", "4;2024-02-03;SARS-CoV-2;PCR em tempo real")
    drop(folder, "3.csv", row.format(5))

    def run(**more):
        drop_folder.ingest_lab(spark, "HPARDINI", str(folder), str(table), str(tmp_path / "cp"), lambda: F.lit("t"), archive=str(done), **more).awaitTermination()

    with pytest.raises(Exception, match="more fields than their header"):
        run()
    assert len(list(folder.iterdir())) == 3
    run(quarantine=str(aside))
    assert tuples(buckets.read(spark, str(table)), "test_id", "SC2_test_result") == [("1", "Pos"), ("2", "Pos"), ("4", None), ("5", "Pos")]
    assert tuples(spark.read.parquet(str(aside)), "file_name", "broken_line", "batch") == [("1.csv", "broken;" + row.format(9), 0), ("2.csv", row.format(3) + ";", 0)]
    assert not list(folder.glob("*.csv")) and sorted(p.name for p in done.rglob("*.csv")) == ["1.csv", "2.csv", "3.csv"]
    assert not list((table / "_staging").iterdir())


def test_events_that_come_again_count_once(spark, tmp_path):
    schema, folder = "id int, ts timestamp, ok boolean", tmp_path / "events"

    def add(*events):
        frame(spark, schema, *[(i, datetime(2024, 1, d, 12), True) for i, d in events]).coalesce(1).write.mode("append").parquet(str(folder))

    for batch in ([(1, 2), (2, 3)], [(2, 3), (3, 5), (3, 5)], [(4, 20)], [(6, 20)], [(1, 2), (9, 2)], [(5, 28)]):  # lateness is judged by the watermark of the batch before
        add(*batch)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
    counted = weekly.weekly_positivity(stream, "ts", F.col("ok"), ~F.col("ok"), minimum=1, event="id")
    counted.writeStream.outputMode("append").format("parquet").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    closed = spark.read.parquet(str(tmp_path / "out"))
    assert set(tuples(closed, "epiweek_enddate", "pos")) == {(date(2024, 1, 6), 3), (date(2024, 1, 20), 2)}
    whole = weekly.weekly_positivity(spark.read.parquet(str(folder)), "ts", F.col("ok"), ~F.col("ok"), minimum=1, event="id")
    assert (date(2024, 1, 6), 4) in tuples(whole, "epiweek_enddate", "pos")


def test_each_delivery_shows_its_date_order(spark):
    rows = frame(
        spark, "DataAtendimento string, DataNascimento string, file_name string",
        ("25/02/2024 08:00", "1/2/1990", "day"), ("03/02/2024", None, "day"), ("02/25/2024", "2/1/1990", "month"), ("03/02/2024", "x", "either"), (None, None, None),
    )
    fixed = header_repair.prepare("SABIN", rows)
    assert tuples(fixed, "file_name", "DataAtendimento", "DataNascimento") == sorted(
        [("day", "2/25/2024", "2/1/1990"), ("day", "2/3/2024", None), ("month", "02/25/2024", "2/1/1990"), ("either", "03/02/2024", "x"), (None, None, None)], key=repr
    )
    forced = header_repair.prepare("SABIN", rows, header_repair.DAY_FIRST)
    assert ("either", "2/3/2024") in tuples(forced, "file_name", "DataAtendimento")
    with pytest.raises(ValueError, match="mixed"):
        header_repair.prepare("SABIN", frame(spark, "DataAtendimento string, DataNascimento string, file_name string", ("25/02/2024", None, "mixed"), ("02/25/2024", None, "mixed")))


def test_exports_run_side_by_side(spark, tmp_path):
    import threading

    meet = threading.Barrier(3, timeout=60)

    def run(i):
        meet.wait()  # breaks unless three are under way at once
        return spark.range(i).count(), spark.sparkContext.getLocalProperty("spark.scheduler.pool")

    assert files.at_once(spark, run, [1, 2, 3]) == [(1, "exports"), (2, "exports"), (3, "exports")]
    with pytest.raises(ZeroDivisionError):
        files.at_once(spark, lambda i: 1 // i, [1, 0, 2])
    tables_ = {f"t{i}": frame(spark, "a int, b string", *[(k, "x") for k in range(i, 0, -1)]) for i in range(1, 6)}
    paths = files.export_catalogue(tables_, str(tmp_path), None, {n: [("a", "desc")] for n in tables_})
    assert [files.read_written(spark, p).count() for p in paths] == [1, 2, 3, 4, 5]


def test_equal_keys_do_not_share_a_task(spark):
    from labwatch.operators.windows import sort_like_postgres

    rows = spark.range(4_000).selectExpr("1 AS k", "id % 2000 AS v")
    parts = sort_like_postgres(rows, ("k", "asc"))
    sizes = [r["n"] for r in parts.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        split = sort_like_postgres(rows, ("k", "asc")).rdd.glom().map(len).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == sum(split) == 4_000 and max(split) < 2_500
    assert [r["v"] for r in parts.collect()][:4] == [0, 0, 1, 1]
