import datetime as dt

import pytest

from conformance import queries_io as io
from conformance import queries_operators as q
from conformance import testbed as tb

ROWS = {
    "nation": [(k, f"N{k}", 0) for k in range(25)],
    "customer": [(k, f"C{k}", 3, 0.0, "BUILDING") for k in range(1, 7)],
    "part": [(1, "P", "B", "T", 10, 1.0)],
    "orders": [(k, k, "F", 1.0, dt.datetime(2001, 7, 30), "1") for k in range(1, 7)],
    "lineitem": [(k, 1, 1, 1, 1.0, 1.0, 0.0, 0.0, "A", "F", dt.datetime(2001, 8, 1)) for k in range(1, 7)],
}


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("small"))
    for name, rows in ROWS.items():
        spark.createDataFrame(rows, tb.SCHEMAS[name]).write.parquet(f"{folder}/{name}.parquet")
    return folder


# customers 1 and 4 are those of the one state


def test_code_maps_keeps_the_nations_of_two_thirds(spark, small):
    assert {r.o_orderkey for r in q.code_maps(spark, small).collect() if r.state} == {2, 3, 5, 6}


def test_null_labels_keeps_the_nations_of_two_thirds(spark, small):
    assert {r.o_orderkey for r in q.null_labels(spark, small).collect() if r.per_100k is not None} == {2, 3, 5, 6}


def test_join_population_keeps_the_places_of_two_thirds(spark, small):
    assert {r.location_ibge_code for r in q.join_population(spark, small).collect()} >= {1000302, 1000303, 1000306}


def test_line_items_are_dealt_to_tasks_by_their_size(spark, small, monkeypatch):
    monkeypatch.setattr(tb, "PER_TASK", 256)
    rows, said = tb.tests(spark, small), tb.spark_table(spark, small, tb.tests_sql("spark"))
    assert rows.rdd.getNumPartitions() == tb.tasks(spark, small) > spark.sparkContext.defaultParallelism
    assert rows.schema == said.schema and sorted(map(repr, rows.collect())) == sorted(map(repr, said.collect()))


def test_orders_are_dealt_to_tasks_by_their_size(spark, small, monkeypatch):
    monkeypatch.setattr(tb, "PER_TASK", 64)
    rows, said = tb.raw_register(spark, small), spark.sql(tb.REGISTER, cases=tb.cases(spark, small))
    assert rows.rdd.getNumPartitions() == tb.tasks(spark, small, "orders") > spark.sparkContext.defaultParallelism
    assert rows.schema == said.schema and sorted(map(repr, rows.collect())) == sorted(map(repr, said.collect()))


def test_a_drop_folder_holds_more_files_when_line_items_are_more(spark, small, monkeypatch):
    seen, delivered = [], io.delivered
    monkeypatch.setattr(io, "delivered", lambda spark, sf_dir, lab_id, parts=3: seen.append(parts) or delivered(spark, sf_dir, lab_id, parts))
    few = io.stream_drop_folder(spark, small).collect()
    monkeypatch.setattr(tb, "PER_TASK", 2048)
    many = io.stream_drop_folder(spark, small).collect()
    assert seen[0] == 3 < seen[1]
    assert sorted(map(repr, few)) == sorted(map(repr, many))


def test_a_merged_catalog_table_has_more_buckets_when_line_items_are_more(spark, small, monkeypatch):
    seen, stored = [], io.tables.as_bucketed_table
    monkeypatch.setattr(io.tables, "as_bucketed_table", lambda df, name, key, buckets, path: seen.append(buckets) or stored(df, name, key, buckets, path))
    few = io.bucketed_merge(spark, small).collect()
    monkeypatch.setattr(tb, "PER_TASK", 256)
    many = io.bucketed_merge(spark, small).collect()
    assert seen[0] == 16 < seen[1] == tb.shares(spark, small)
    assert sorted(map(repr, few)) == sorted(map(repr, many))
