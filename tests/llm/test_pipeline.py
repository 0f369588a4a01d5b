"""The stages in a row, and the registered queries on the smallest tables."""

import pytest

import __spark_entry__
import corpus_pipeline
from conformance.check import compare
from conformance.testbed import TABLES
from labwatch.llm import registry

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = [docs.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        rows = out.collect()
        sizes.append(len(rows))
        docs = spark.createDataFrame(rows, out.schema)
        assert k != 2 or len({r["doc_id"] for r in rows}) == len(rows)
    assert sizes == sorted(sizes, reverse=True) and sizes[3] == sizes[4]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert len(last) == sizes[4] and all(r["parity"] and r["round_trip"] for r in last)


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_registered():
    names = __spark_entry__.queries()
    assert {f"op{n}" for n in range(1, 14)} <= {x.split("_")[0] for x in names} and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_agrees_with_sql(spark, name):
    verdict, *_ = compare(spark, registry.QUERIES[name], registry.SQL[name], SF, TABLES)
    assert verdict == "ok", verdict


def test_the_order_of_the_mix_reaches_the_end(spark, tmp_path):
    """Files of the mix, read in any order, still tell where each row stood."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(100)
    mixed = corpus_pipeline.mixed_sources(spark, docs, SF).repartitionByRange(3, "n_chars").sortWithinPartitions("n_chars", "doc_id")
    mixed.write.parquet(str(tmp_path / "m"))
    order = [r["doc_id"] for r in mixed.collect()]
    out = corpus_pipeline.tokenized(spark, spark.read.parquet(str(tmp_path / "m")), SF)
    assert [r["doc_id"] for r in out.orderBy("position").collect()] == order
    made = spark.createDataFrame(docs.limit(5).collect(), docs.schema)  # rows from no file have no place
    assert {r["position"] for r in corpus_pipeline.tokenized(spark, made, SF).collect()} == {None}
