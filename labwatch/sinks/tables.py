"""Materialisation: a view, a plain table, or a catalog table in buckets. Merged tables are in ``buckets``."""

from __future__ import annotations

from pyspark.sql import DataFrame


def as_view(df: DataFrame, name: str) -> DataFrame:
    """A name for the plan; every read computes it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def as_table(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Write and read back."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.parquet(path)


def as_bucketed_table(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """A catalog table whose files are bucketed and sorted by the key.

    Joins, anti joins and aggregates on the key then read the table where it
    lies: only the other side moves, and none if it has the same buckets. The
    rows are brought together by key first, so that a bucket is one file.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)
